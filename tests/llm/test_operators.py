"""Training-data operators against brute force, with nulls, empty texts, ties and odd columns."""

import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import minhash, oracle, suffixes, vectors
from basketry.llm.components import components, merged
from basketry.llm.decontaminate import decontaminate, make_block
from basketry.llm.language import fit_language
from basketry.llm.minhash import near_duplicates
from basketry.llm.mixing import mix_sources, word_count
from basketry.llm.sharding import shard
from basketry.llm.suffixes import remove_repeats
from basketry.llm.tokens import read_token_ids, token_positions, write_token_ids
from basketry.llm.toxicity import fit_toxicity
from basketry.llm.urls import Rule, judge_urls
from basketry.llm.vectors import near_vectors

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, source string, size string, _row int"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdeéß", k=rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 12, 40, 200, 200, 300)]
    near = base[4].split()
    near[100] = "other"
    passage = prose(rng, 60)
    out = [*base, base[3], " ".join(near), base[5] + " " + passage, passage + " " + base[2], None, "", "!!", "", "a" * 5000, "a" * 700]
    return [(i, t, "AB"[i % 2] if i % 5 else None, "x", i) for i, t in enumerate(out)] + [(3, base[3], "B", "x", 0), (None, base[0], "A", "y", 1)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS).repartition(3).cache()


def test_repeats_match_brute_force(spark, docs, texts):
    got = remove_repeats(docs).collect()
    first = {}
    rows = [(i if i is not None else 2**63, (t or "").encode()) for i, t, *_ in texts]
    for i, b in rows:
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(i, first.get(b[p : p + 50], i))
    want = []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, len(b), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    assert sorted((r["id"] if r["id"] is not None else 2**63, r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in got) == sorted(want)
    assert remove_repeats(docs.limit(0)).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("repeat_chunks")]


def test_intervals_match_sorted_strings():
    rng = np.random.default_rng(1)
    pieces = [rng.integers(97, 100, n).astype(np.uint8) for n in (60, 75, 300, 50)]
    pieces += [pieces[2][10:120].copy(), np.full(400, 97, np.uint8)]
    owner = np.array([4, 2, 9, 1, 3, 7])
    got = suffixes.least_owner(np.concatenate(pieces), np.array([len(p) for p in pieces]), owner)
    strings = [(bytes(p[i : i + 50]), o) for p, o in zip(pieces, owner, strict=True) for i in range(len(p) - 49)]
    least = {}
    for s, o in strings:
        least[s] = min(o, least.get(s, o))
    assert got.tolist() == [least[s] for s, _ in strings]


def test_near_duplicates_find_copies_and_leave_others(docs):
    got = {(r["doc_id"], r["text"]): (r["class_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    by_id = {k[0]: v for k, v in got.items()}
    assert by_id[6] == (3, False) and by_id[3] == (3, True)
    assert by_id[7] == (4, False) and by_id[10] == (10, True)
    assert by_id[11] == (11, True) and by_id[13] == (11, False) and by_id[12] == (12, True)
    assert by_id[None] == (0, False) and by_id[1] == (1, True)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_class_is_kept(spark, texts):
    base = texts[3][1]
    rows = [(1, base, "x")] * 3 + [(1, base, "y"), (2, base, "x"), (None, base, "x")]
    rows += [(None, texts[4][1], "x")] * 3 + [(None, texts[4][1], "a")]
    rows += [(7, None, "x")] * 2 + [(None, None, "x")] * 2 + [(1, texts[5][1], "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, other string")
    got = near_duplicates(frame.repartition(4)).collect()
    assert sorted(map(str, (tuple(r)[:3] for r in got))) == sorted(map(str, rows))
    kept = sorted(str((r["doc_id"], r["text"])) for r in got if r["kept"])
    want = [(1, base), (None, texts[4][1]), (7, None), (None, None), (None, None), (1, texts[5][1])]
    assert kept == sorted(map(str, want))
    again = near_duplicates(frame.repartition(7)).where("kept").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in got if r["kept"])


def test_mixing_stage_copies_rows_and_not_ids(spark, texts):
    folder = "/root/testdata/sf0.001"
    rows = [(1, texts[2][1], "A"), *[(2, texts[3][1], "A")] * 5, *[(None, texts[4][1] + f" {i}", "B") for i in range(6)], (3, texts[5][1], "C")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.mixing(spark, docs, folder)
    assert got.columns == docs.columns
    many = {(r["doc_id"], r["text"]): r["count"] for r in got.groupBy("doc_id", "text").count().collect()}
    for i, t, _ in set(rows):  # the mix takes each row up to two times
        assert many.get((i, t), 0) <= 2 * sum(r[:2] == (i, t) for r in rows)
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "ABC"}
    taken = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect()}
    most = max(len(t.split()) for _, t, _ in rows)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 3 * most


def test_idf_depends_on_the_share_of_a_shingle_only(spark):
    rng = random.Random(8)
    some = [prose(rng, 30) for _ in range(40)]
    texts = [rng.choice(some) for _ in range(200)]

    def idf(rows):
        frame = spark.createDataFrame([(t,) for t in rows], "text string")
        hashes, values, rest = minhash.inverse_document_frequencies(frame)
        return dict(zip(hashes.tolist(), values.tolist(), strict=True)), rest

    once, rest = idf(texts)
    twice, _ = idf(texts * 2)
    total, held = 26 * len(texts), {t: texts.count(t) for t in set(texts)}
    want = sorted(1 + math.log2(total / n) / 18 for t, n in held.items() for _ in range(26) if n > 1)
    assert np.allclose(sorted(once.values()), want) and math.isclose(rest, 1 + math.log2(total) / 18)
    assert all(math.isclose(twice[h], v) for h, v in once.items())
    assert minhash.damped(1 << 30, 1) == minhash.damped(1 << 40, 5) == 2


def test_a_large_group_of_near_copies_stays_together(spark):
    rng = random.Random(4)
    base = [prose(rng, 1) for _ in range(200)]
    copies = []
    for i in range(300):  # each pair has a plain Jaccard similarity of 0.9
        own = list(base)
        own[rng.randrange(10, 190)] = f"own{i}"
        copies.append((i, " ".join(own)))
    frame = spark.createDataFrame([*copies, (300, prose(rng, 200))], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(frame).collect()}
    assert got == {i: 0 for i in range(300)} | {300: 300}


def test_wide_buckets_give_the_links_of_narrow_ones(spark, monkeypatch):
    rng = random.Random(9)
    base = [prose(rng, 1) for _ in range(150)]
    rows = []
    for i in range(160):  # from close to far copies: some pairs are linked, some are not
        own = list(base)
        for p in rng.sample(range(150), rng.randrange(12)):
            own[p] = f"own{i}x{p}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", 0)
    monkeypatch.setattr(minhash, "BLOCK_NODES", 20)

    def classes(wide):
        return {r["doc_id"]: r["class_id"] for r in near_duplicates(frame, wide=wide).collect()}

    narrow = classes(10**6)
    assert classes(0) == narrow and classes(30) == narrow
    assert 1 < len(set(narrow.values())) < 160


def test_decontamination_matches_brute_force(spark, docs, texts):
    rng = random.Random(8)
    source = words_of(texts[5][1])
    items = [("b", " ".join(source[20:45]).upper()), ("a", prose(rng, 30)), ("c", " ".join(source[3:6])), ("d", "?!"), (None, None), ("e", " ".join(source[100:109]))]
    frame = spark.createDataFrame(items, "item_id string, text string")
    windows = []
    for i, t in items:
        w = words_of(t)
        windows += [(i, tuple(w[p : p + 10])) for p in range(max(1, len(w) - 9))] if w else []
    want = []
    for i, t, *_ in texts:
        w, hit, found = words_of(t), set(), set()
        for name, g in windows:
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p : p + len(g)]) == g:
                    hit |= set(range(p, p + len(g)))
                    found.add(name)
        want.append((str(i), len(w), len(hit), sorted(found)))
    for block in (200_000, 4):  # one block, and several
        got = decontaminate(docs, frame, block_windows=block).collect()
        rows = [(str(r["doc_id"]), c["n_words"], sum(s["end"] - s["start"] for s in c["spans"]), c["items"]) for r in got for c in [r["contamination"]]]
        assert sorted(rows) == sorted(want)
    assert decontaminate(docs, frame.limit(0)).count() == docs.count()
    assert decontaminate(docs.limit(0), frame).count() == 0


def test_items_that_share_a_window_are_told_once():
    hashes = np.arange(12, dtype=np.uint64)
    block = make_block([(str(i % 3000), hashes) for i in range(6000)], 10)
    assert len(block.grid) == 3 and all(len(o) == 3000 for o in block.owners)


def test_mix_reaches_targets(spark, docs):
    got = mix_sources(docs, word_count(F.col("text"))).collect()
    assert len(got) == docs.count() and {"_row", "text"} <= set(got[0].asDict())
    sizes = {r["source"]: r["source_size"] for r in got}
    assert math.isclose(sum({r["source"]: r["target"] for r in got}.values()), 1.5 * sum(sizes.values()))
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        assert all(r["taken"] <= 2 * r["size"] for r in own) and own[0]["target"] <= 2 * own[0]["source_size"] + 1e-9
    again = mix_sources(docs.repartition(7), word_count(F.col("text"))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mix_sources(docs.limit(0), word_count(F.col("text"))).count() == 0


def test_shards_fit_and_split_only_where_needed(spark):
    data = [(i, 10 + i % 7) for i in range(400)] + [(7, 60)] * 30 + [(1000, 900), (None, 5)]
    frame = spark.createDataFrame(data, "doc_id long, n int")
    got = shard(frame, F.col("n"), limit=200).collect()
    assert sorted(map(str, ((r["doc_id"], r["n"]) for r in got))) == sorted(map(str, data))
    sums, many = {}, {}
    for r in got:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["n"]
        many[r["shard"]] = many.get(r["shard"], 0) + 1
    assert all(s <= 200 or many[k] == 1 for k, s in sums.items())
    plain = [k for k in sums if "-" not in k]
    for k in plain:  # the parent of a shard is too large
        assert sum(s for x, s in sums.items() if x.startswith(k[:-1])) > 200
    assert shard(frame.limit(0), F.col("n")).count() == 0


def test_many_small_shards_match_sql(spark):
    limit, path = 64 << 10, "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    got = shard(docs, F.col("n_bytes"), limit=limit).select("doc_id", "n_bytes", "shard", "shard_depth").collect()
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    assert sorted(map(tuple, got)) == sorted(base.execute(oracle.shard_sql(limit)).fetchall())
    assert len({r["shard"] for r in got}) > 30


def test_runs_of_one_hash_are_cut_where_rows_come_in(spark):
    data = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(10).alias("n")).repartition(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = shard(data, F.col("n"), limit=1000).groupBy("shard").agg(F.sum("n")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r[1] for r in got) == 40_000 and max(r[1] for r in got) <= 1000 and len(got) <= 88


def test_token_files_round_trip(spark, docs, texts, tmp_path):
    import public_tokenizers
    import tokenizers

    name = public_tokenizers.path("word_bpe_49k.json")
    odd = "it's 3,5  İÉ\té\n<|endoftext|>. x²."
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([(50, odd)], "doc_id long, text string"))
    write_token_ids(frame, str(tmp_path / "t"), name)
    plain = tokenizers.Tokenizer.from_file(name)
    want = sorted(([-1 if i is None else i, [*plain.encode(t or "", add_special_tokens=False).ids, 2]] for i, t in [*((x[0], x[1]) for x in texts), (50, odd)]))
    kind = frame.schema["doc_id"].dataType
    back = read_token_ids(spark, str(tmp_path / "t"), kind).collect()
    assert sorted([-1 if r["id"] is None else r["id"], r["ids"]] for r in back) == want
    places = token_positions(spark, str(tmp_path / "t"), kind).collect()
    crc = {r["start"]: (r["n_tokens"], r["ids_crc32"]) for r in places}
    at = 0
    for _, ids in want:
        assert crc[at] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1050)] + [(5, 5)]

    def found_by_hand(links):
        up = {}

        def top(x):
            while up.setdefault(x, x) != x:
                x = up[x]
            return x

        for a, b in links:
            if a != b:
                a, b = sorted((top(a), top(b)))
                up[b] = a
        return {x: top(x) for x in up}

    def frame(rows):
        return spark.createDataFrame(rows, "a long, b long")

    want = sorted(found_by_hand(links).items())
    assert sorted(map(tuple, components(frame(links)).collect())) == want
    assert components(frame(links).limit(0)).count() == 0
    before = found_by_hand(links[:150])
    between = [(before.get(a, a), before.get(b, b)) for a, b in links[150:]]
    after = merged(merged(None, frame(links[:150])), frame(between))
    assert sorted(map(tuple, after.collect())) == want


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16))
    data = [(i, int(i % 3), [float(x) for x in centres[i % 40] + rng.standard_normal(16) * 0.12]) for i in range(1500)]
    data += [(i + 2000, 0, data[0][2]) for i in range(50)]
    data += [(3000, None, data[0][2]), (3001, 0, None), (3002, 0, [0.0] * 16), (3003, 0, [float("nan")] * 16), (3004, 0, [1.0]), (3005, 0, [])]
    frame = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")
    got = {r["vec_id"]: r for r in near_vectors(frame).collect()}
    good = [d for d in data if d[0] < 3000]
    x = np.array([d[2] for d in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([d[1] for d in good])
    link = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    found = sum(got[d[0]]["n_links"] for d in good)
    assert found >= 0.98 * link.sum() and all(got[d[0]]["n_links"] <= n for d, n in zip(good, link.sum(1), strict=True))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (3000, 3001, 3002, 3003, 3004, 3005))
    assert near_vectors(frame.limit(0)).count() == 0


def test_vectors_of_many_skewed_labels_keep_their_links(spark, monkeypatch):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(vectors, "SAMPLE", 400)  # about 20 vectors of a label of 700
    data = []
    for label, many in [("big", 5000), *((f"mid{i}", 700) for i in range(6)), *((f"few{i}", 20) for i in range(30))]:
        centres = rng.standard_normal((max(1, many // 25), 16))
        for i in range(many):
            data.append((len(data), label, [float(x) for x in centres[i % len(centres)] + rng.standard_normal(16) * 0.2]))
    data.append((len(data), "wide", [1.0] * 65_536))
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(spark.createDataFrame(data, "vec_id long, label string, embedding array<double>").repartition(8)).collect()}
    recall = {}
    for label in {d[1] for d in data} - {"wide"}:
        own = [d for d in data if d[1] == label]
        x = np.array([d[2] for d in own])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link = x @ x.T >= 0.93
        np.fill_diagonal(link, False)
        found = sum(got[d[0]] for d in own)
        assert found <= link.sum()
        recall[label[:3]] = [*recall.get(label[:3], []), found / max(1, link.sum()) if link.any() else 1.0]
    assert min(recall["few"]) == 1 and min(recall["mid"]) >= 0.98 and min(recall["big"]) >= 0.98, recall


def test_small_groups_go_through_trees(spark):
    rng = np.random.default_rng(9)
    data = []
    for label, many in [(str(i), 40 + 60 * i) for i in range(7)]:
        centres = rng.standard_normal((max(1, many // 5), 16))
        data += [(len(data) + i, label, [float(x) for x in centres[i % len(centres)] + rng.standard_normal(16) * 0.15]) for i in range(many)]
    frame = spark.createDataFrame(data, "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(frame).collect()}
    x = np.array([d[2] for d in data])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([d[1] for d in data])
    link = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    assert 0.98 * link.sum() <= sum(got.values()) <= link.sum()


def test_urls_follow_rules_then_purity(spark):
    rules = [Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow")]
    urls = ["http://A.Example.com/en/1?x", "https://www.example.com/en/1", "http://b.com/x#y", "http://b.org/p/1", "nothing", None, "http://example.com", "http://b.org/" + "a/" * 3000]
    frame = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    got = {r["page_id"]: r for r in judge_urls(frame, rules).collect()}
    assert [got[i]["verdict"] for i in range(4)] == ["block", "allow", "allow", "allow"]
    assert (got[0]["host"], got[0]["path"], got[0]["rule"]) == ("a.example.com", "/en/1", "example.com/en/")
    assert (got[4]["host"], got[5]["path"], got[5]["verdict"]) == ("", "", "allow")
    pages = [(i, f"http://spam.org/ad/{i}", 1 if i < 40 else None) for i in range(50)] + [(100 + i, f"http://spam.org/news/{i}", 0) for i in range(40)]
    frame = spark.createDataFrame(pages, "page_id long, url string, bad int")
    got = {r["page_id"]: r["verdict"] for r in judge_urls(frame, [], label=F.col("bad")).collect()}
    assert {got[i] for i in range(50)} == {"block"} and {got[100 + i] for i in range(40)} == {"allow"}
    assert judge_urls(frame.limit(0), rules).count() == 0


def test_purity_judges_unlabelled_slugs_by_their_siblings(spark):
    def slug(i):
        return "".join("abcdefghij"[int(d)] for d in f"{i:02}")

    pages = []
    for host, bad in (("spam.org", 1), ("good.org", 0)):
        pages += [(f"http://{host}/ad/{slug(i)}", None if i % 10 == 0 else bad) for i in range(40)]  # a wildcard
        pages += [(f"http://few.{host}/{slug(i)}/x", None if i == 0 else bad) for i in range(6)]  # a merge
        pages += [(f"http://none.{host}/{slug(i)}", None) for i in range(40)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, bad int")
    got = judge_urls(frame, [], label=F.col("bad")).where("bad IS NULL").collect()
    verdicts = {h: {r["verdict"] for r in got if r["host"] == h} for h in {r["host"] for r in got}}
    assert verdicts == {
        "spam.org": {"block"}, "few.spam.org": {"block"}, "none.spam.org": {"allow"},
        "good.org": {"allow"}, "few.good.org": {"allow"}, "none.good.org": {"allow"},
    }


def test_templates_reach_the_end_of_deep_paths(spark):
    deep = "http://x.org/" + "a/b/c/d/e/f/" * 50
    pages = [(deep + f"ads/s/{i}", 1 if i else None) for i in range(40)] + [(deep + f"news/s/{i}", 0 if i else None) for i in range(40)]
    pages += [("http://x.org/" + "a/" * i, None) for i in range(1, 60)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, bad int")
    got = {r["page_id"]: r for r in judge_urls(frame, [], label=F.col("bad")).collect()}
    assert len(got) == len(pages)
    assert got[0]["verdict"] == "block" and got[40]["verdict"] == "allow"
    assert got[0]["template"].endswith("/ads/s/{n}") and got[40]["template"].endswith("/news/s/{n}")
    assert got[80]["template"] == "/a" and {got[i]["verdict"] for i in range(80, len(pages))} == {"allow"}


def test_toxicity_and_language_on_held_out_rows(spark, docs):
    folder = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    rows = given.join(labels, "doc_id")
    model = fit_toxicity(rows.where(~held).withColumnRenamed("toxic", "label"))
    right = model.score(rows.where(held)).agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.85
    assert model.score(docs).count() == docs.count()
    empty = fit_toxicity(rows.limit(0).withColumnRenamed("toxic", "label"))
    assert empty.score(docs).where("score = 0").count() == docs.count()
    language = fit_language(given.where(~held))
    right = language.predict(given.where(held)).agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.97
    assert language.predict(docs).where("lang_pred = 'und'").count() == 4
    nothing = fit_language(given.limit(0))
    assert nothing.predict(docs).where("lang_pred = 'und'").count() == docs.count()
