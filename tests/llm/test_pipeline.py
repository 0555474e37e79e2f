"""The pipeline's stages one by one against plain versions, and the whole run, on the smallest tables."""

import math
import re
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import registry
from basketry.session import stash

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def staged(spark, given):
    """What each stage returns, in order, beginning with the documents."""
    out = [given]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stash(stage(spark, out[-1], FOLDER), f"test-{name}"))
    return out


def ids(df):
    return [r[0] for r in df.select("doc_id").orderBy("doc_id").collect()]


def shingles(text):
    w = words_of(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def classes_of(texts):
    """Least id of each text's class: all pairs, weighted Jaccard similarity of 0.8 or more."""
    bags = {i: shingles(t) for i, t in texts.items()}
    seen = Counter(s for bag in bags.values() for s in bag)
    total = sum(k for bag in bags.values() for k in bag.values())
    idf = {s: 1 + min(1.0, math.log2(total / f) / 18) for s, f in seen.items()}
    weights = {i: {s: k * idf[s] for s, k in bag.items()} for i, bag in bags.items()}
    total = {i: sum(w.values()) for i, w in weights.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(texts), 2):
        if texts[i] == texts[j]:
            alike = True
        else:
            both = sum(min(w, weights[j].get(s, 0.0)) for s, w in weights[i].items())
            alike = both > 0 and both / (total[i] + total[j] - both) >= 0.8
        if alike:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i in texts}


def test_near_duplicates_keep_the_least_of_each_class(spark, staged):
    before, after = staged[1], staged[2]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    want = classes_of(texts)
    assert ids(after) == sorted(set(want.values()))
    assert len(set(want.values())) < len(want)


def test_op5_links_what_all_pairs_link(spark, given):
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    got = {r["doc_id"]: r["class_id"] for r in registry.QUERIES["op5_near_duplicates"](spark, FOLDER).collect()}
    assert got == classes_of(texts)


def test_toxicity_drops_what_the_model_rejects(spark, given, staged):
    model = registry.toxicity_model(spark, given, FOLDER)
    scored = {r["doc_id"]: r["score"] for r in model.score(given).collect()}
    assert ids(staged[1]) == sorted(i for i, s in scored.items() if s < 0.3)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean = [i for i, t in labels.items() if t == 0 and i in scored]
    kept = set(ids(staged[1]))
    assert sum(i in kept for i in clean) > 0.8 * len(clean)


def test_decontamination_drops_documents_with_a_window(spark, staged):
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words_of(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    lengths = {len(w) for w in windows}

    def hit(text):
        w = words_of(text)
        return any(tuple(w[i : i + n]) in windows for n in lengths for i in range(len(w) - n + 1))

    rows = {r["doc_id"]: r["text"] for r in staged[2].collect()}
    assert ids(staged[3]) == sorted(i for i, t in rows.items() if not hit(t))


def test_mixing_takes_each_source_near_its_target(spark, staged):
    def size(text):
        return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))

    before = {r["doc_id"]: r for r in staged[3].collect()}
    taken = Counter(r["doc_id"] for r in staged[4].collect())
    sources = sorted({r["source"] for r in before.values()}, key=lambda s: (s is None, s))
    total = {s: sum(size(r["text"]) for r in before.values() if r["source"] == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    left, open_, target = 1.5 * sum(total.values()), set(sources), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * total[s]}
        target |= {s: 2 * total[s] for s in full} or share
        left -= sum(2 * total[s] for s in full)
        open_ = open_ - full if full else set()
    assert max(taken.values()) <= 2 and set(taken) <= set(before)
    for s in sources:
        own = sum(n * size(before[i]["text"]) for i, n in taken.items() if before[i]["source"] == s)
        largest = max(size(r["text"]) for r in before.values() if r["source"] == s)
        assert abs(own - target[s]) <= largest


def test_stages_keep_columns_and_the_run_is_their_sequence(spark, given, staged):
    for df in staged[:-1]:
        assert df.columns == given.columns
    assert staged[-1].columns[: len(given.columns)] == given.columns
    run = corpus_pipeline.run(spark, FOLDER)
    assert run.columns == staged[-1].columns
    assert ids(run) == ids(staged[-1])


def test_stages_take_an_empty_table(spark, given):
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, given.limit(0), FOLDER).count() == 0, name


def test_stages_take_nulls_and_repeated_rows(spark, given):
    odd = given.limit(3).withColumn("text", F.lit(None).cast("string"))
    odd = odd.unionByName(odd).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    docs = stash(given.unionByName(odd).withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.col("source"))), "test-odd")
    for name, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, FOLDER), f"test-odd-{name}")
        assert docs.count() > 0
