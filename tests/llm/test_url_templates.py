"""URL templates against a plain recursive version, and branches that must not be merged."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.llm.urls import judge_urls

MANY, RARE, ALPHA, SMOOTHING, AGREEING = 8, 0.05, 0.05, 4.0, 3


def wide(n, m, more=0.0):
    return (more + math.sqrt(0.5 * math.log(2 / ALPHA))) * (1 / math.sqrt(n) + 1 / math.sqrt(m))


def path(parts):
    return "".join("/" + p for p in parts)


def grow(rows, node, out):
    """rows: [(rest, shape, n, labelled, blocked)] of a node; out: shape -> template."""
    last = max(r[0] for r in rows)
    parting = [next((i for i, (x, y) in enumerate(zip(r[0], last)) if x != y), None) for r in rows]
    forks = [p for p in parting if p is not None]
    fork = min(forks) if forks else None
    children = {}
    for r in rows:
        if fork is None or len(r[0]) <= fork:
            out[r[1]] = node + path(r[0])
        else:
            children.setdefault(r[0][fork], []).append((r[0][fork + 1 :], *r[1:]))
    if not children:
        return
    node += path(last[:fork])
    follows = {c: Counter() for c in children}
    for c, held in children.items():
        for rest, _, n, _, _ in held:
            follows[c][rest[0] if rest else None, len(rest)] += n
    pool = sum(follows.values(), Counter())
    total = {c: [sum(r[k] for r in held) for k in (2, 3, 4)] for c, held in children.items()}
    pn, pl, pb = (sum(t[k] for t in total.values()) for k in range(3))
    similar = {}
    for c, (n, labelled, blocked) in total.items():
        m = pn - n
        if m:
            apart = sum((follows[c][s] / n - (pool[s] - follows[c][s]) / m) ** 2 for s in pool)
            good = math.sqrt(apart) <= wide(n, m, 1)
            if good and labelled and pl > labelled:
                good = abs(blocked / labelled - (pb - blocked) / (pl - labelled)) <= wide(labelled, pl - labelled)
        similar[c] = bool(m) and good
    agree = sum(similar[c] and total[c][1] > 0 for c in children)
    merged = {}
    for c, (n, labelled, _) in total.items():
        if len(children) >= MANY and n < RARE * pn:
            token = "*"
        elif similar[c] and (labelled or not pl or agree >= AGREEING):
            token = "+"
        else:
            token = c
        merged.setdefault(token, []).extend(children[c])
    for token, held in merged.items():
        grow(held, f"{node}/{token}", out)


def brute(pages):
    """pages: [(host, path, label)] -> [(template, purity)]."""
    def shape(p):
        return re.sub("[0-9]+", "{n}", "/".join(s for s in p.split("/") if s))

    counts = {}
    for host, p, label in pages:
        held = counts.setdefault(host, {}).setdefault(shape(p), [0, 0, 0])
        held[0] += 1
        held[1] += label is not None
        held[2] += label or 0
    templates, sums = {}, {}
    for host, shapes in counts.items():
        out = {}
        grow([(tuple(s.split("/")) if s else (), s, *v) for s, v in shapes.items()], "", out)
        for s, template in out.items():
            templates[host, s] = template
            held = sums.setdefault((host, template), [0, 0])
            held[0] += shapes[s][2]
            held[1] += shapes[s][1]
    found = []
    for host, p, _ in pages:
        template = templates[host, shape(p)]
        bad, labelled = sums[host, template]
        found.append((template, bad / (labelled + SMOOTHING)))
    return found


def verdicts(spark, pages):
    frame = spark.createDataFrame([(i, f"http://{h}{p}", b) for i, (h, p, b) in enumerate(pages)], "page_id long, url string, bad int")
    return judge_urls(frame, [], label=F.col("bad")).orderBy("page_id").collect()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_paths_match_the_plain_version(spark, seed):
    rng = random.Random(seed)
    pages = []
    for _ in range(900):
        host = rng.choice(["a.org", "b.org"])
        top = rng.choices(["ads", "news", "shop", "x", "y", ""], weights=[5, 5, 3, 1, 1, 1])[0]
        parts = [top, *rng.choices(["a", "b", "c", "deep", "12", f"s{rng.choice('abcdefghijklm')}"], k=rng.randint(0, 3))]
        label = rng.choice([None, None, 1 if top in ("ads", "x") else 0])
        pages.append((host, path(parts), label))
    got = verdicts(spark, pages)
    want = brute(pages)
    assert [r["template"] for r in got] == [t for t, _ in want]
    assert [r["purity"] for r in got] == pytest.approx([p for _, p in want], abs=1e-12)
    assert {r["verdict"] for r in got} == {"block", "allow"}


def test_one_labelled_branch_says_nothing_about_its_neighbours(spark):
    pages = [("spam.org", f"/ads/{i}", 1) for i in range(10)] + [("spam.org", f"/news/{i}", None) for i in range(500)]
    got = verdicts(spark, pages)
    assert {r["verdict"] for r in got[:10]} == {"block"} and {r["verdict"] for r in got[10:]} == {"allow"}


def test_a_branch_of_another_structure_is_not_merged(spark):
    pages = [("spam.org", f"/{c}/buy/{i}", 1) for c in ("aa", "bb", "cc", "dd") for i in range(40)]
    like = [("spam.org", f"/ee/buy/{i}", None) for i in range(40)]
    other = [("spam.org", f"/docs/{d}/{i}/x", None) for d in ("guide", "api") for i in range(20)]
    got = verdicts(spark, pages + like + other)
    assert {r["verdict"] for r in got[:200]} == {"block"}
    assert {r["verdict"] for r in got[200:]} == {"allow"}
