"""Spelling variants, byte-level BPE and whitening against brute force and the public libraries."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import bpe, spelling, whitening
from basketry.llm.bpe import decode_ids, encode_texts, round_trip_digests
from basketry.llm.spelling import count_words, near_pairs, spelling_variants
from basketry.llm.text import utf8
from basketry.llm.whitening import fit_whitening, jacobi_davidson, whiten

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# --- spelling variants ----------------------------------------------------------------------


def words_brute(rows, drop_every):
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if drop_every and h % drop_every == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            total[low] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_brute(words):
    near = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(3)
    base = ["".join(rng.choices("abcàé", k=rng.randint(4, 9))) for _ in range(60)]
    base += ["abcab" + c for c in "abcdexyz"] + ["x" * 2100, "x" * 2101, "anagram", "nagaram"]
    texts = []
    for i in range(150):
        chosen = rng.choices(base, weights=[1 / (k + 1) for k in range(len(base))], k=60)
        edited = [w[:2] + rng.choice("abÀ") + w[3:] if rng.random() < 0.3 else w for w in chosen]
        texts.append((i, "; ".join(w.upper() if rng.random() < 0.1 else w for w in edited), "source"))
    return [*texts, texts[0], texts[0], (None, texts[1][1], None), (200, None, "x"), (201, "", "x"), (202, "12 !? ×÷", "n")]


@pytest.mark.parametrize("drop_every", [None, 3, 97])
def test_variants_match_brute_force(spark, spelled, drop_every):
    docs = spark.createDataFrame(spelled, "doc_id long, text string, word string").repartition(5)
    words = words_brute([(d, t) for d, t, _ in spelled], drop_every)
    got = spelling_variants(count_words(docs, drop_every=drop_every))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == variants_brute(words)
    assert any(root not in (word, form) for word, form, root, *_ in got.collect())


def test_small_tiles_and_flushes_change_nothing(spark, spelled, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_WORDS", 3)
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    monkeypatch.setattr(spelling, "VERIFY_LETTERS", 40)
    docs = spark.createDataFrame(spelled, "doc_id long, text string, word string")
    words = words_brute([(d, t) for d, t, _ in spelled], None)
    assert sorted(map(tuple, spelling_variants(count_words(docs)).collect())) == variants_brute(words)


def test_words_given_as_a_table(spark):
    rows = [("abcde", 10, 1), ("abcdf", 4, 2), ("abcdf", 1, 2), ("abcdg", 10, 0), (None, 5, 0), ("", 5, 0), ("zzzzz", None, 0), ("lone", 3, 0), ("漢字漢字", 9, 0), ("漢字漢語", 3, 0)]
    words = spark.createDataFrame(rows, "word string, n long, block int")
    got = {r["word"]: tuple(r)[1:] for r in spelling_variants(words).collect()}
    assert got["abcdf"] == ("abcde", "abcde", 5, 2, 10)
    assert got["abcde"] == (None, "abcde", 10, 2, None)
    assert got["漢字漢語"] == ("漢字漢字", "漢字漢字", 3, 1, 9)
    assert set(got) == {"abcde", "abcdf", "abcdg", "lone", "漢字漢字", "漢字漢語"}
    assert spelling_variants(words.limit(0)).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(count_words(docs)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_near_pairs_of_any_words(data):
    length = data.draw(st.integers(1, 7))
    more = data.draw(st.sampled_from([0, 1]))
    word = st.text(alphabet="abàÿü漢", min_size=length, max_size=length)
    longer = st.text(alphabet="abàÿü漢", min_size=length + more, max_size=length + more)
    a, b = data.draw(st.lists(word, min_size=1, max_size=12)), data.draw(st.lists(longer, min_size=1, max_size=12))
    i, j = near_pairs(a, b)
    want = [(x, y) for x in range(len(a)) for y in range(len(b)) if one_edit(a[x], b[y])]
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == want


# --- byte-level BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder(ranks):
    return bpe.ByteBPE(ranks)


def agree(coder, library, texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    ids, counts = coder.encode(data, offsets)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for text, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[a:b].tolist() == library.encode_ordinary(text or ""), text
    back, places = coder.decode(ids, ends)
    assert back.tobytes() == data.tobytes() and places.tolist() == offsets.tolist()


def test_every_code_point_is_split_as_the_library_does(coder, library):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 5000):
        pieces = chars[at : at + 5000]
        agree(coder, library, ["".join(f" a{c}1{c}!{c} {c}{c}" for c in pieces[k : k + 50]) for k in range(0, len(pieces), 50)])


def test_random_strings_match_the_library(coder, library):
    rng = random.Random(11)
    alphabet = "aabst'’lvedrm  \n\t 19.,!éİ 中　 ́\x1c😀"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(20_000)]
    agree(coder, library, [*texts, "", None, "a" * 5000, "'" * 3000, " " * 4000, "ab" * 3000 + "\n", "<|endoftext|>"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=8))
def test_any_text_matches_the_library(coder, library, texts):
    agree(coder, library, texts)


def test_a_full_memory_is_emptied(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "HELD_BYTES", 1000)
    monkeypatch.setattr(bpe, "HELD_PIECE", 6)
    rng = random.Random(2)
    for _ in range(20):
        agree(coder, library, ["".join(rng.choices("abcdefg ", k=200)) for _ in range(5)])


def test_perfect_hash_is_minimal_and_knows_strangers(coder):
    table = coder.table
    assert sorted(table.key_at.tolist()) == list(range(len(coder.tokens)))
    ends = table.starts + table.lengths
    assert table.find(table.data, table.starts, ends).tolist() == list(range(len(coder.tokens)))
    strange = b"".join(t + b"\x00q" for t in coder.tokens[:3000])
    lengths = np.array([len(t) + 2 for t in coder.tokens[:3000]])
    stops = np.cumsum(lengths)
    assert (table.find(np.frombuffer(strange, np.uint8), stops - lengths, stops) == -1).all()


def test_bpe_tables(spark, ranks, library):
    texts = ["It's  a test, they'll see\n\n 12 cafés", None, "", "x" * 3000, "It's  a test, they'll see\n\n 12 cafés"]
    rows = [(i if i else None, t, "given", b"b") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, bytes binary")
    coded = encode_texts(docs, RANKS)
    assert coded.columns == ["doc_id", "text", "bytes", "ids"]
    back = decode_ids(coded, RANKS).collect()
    assert sorted((r["text"] or "", r["ids"], bytes(r["bytes"])) for r in back) == sorted(
        (t or "", library.encode_ordinary(t or ""), (t or "").encode()) for t in texts
    )

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    got = sorted(tuple(r) for r in round_trip_digests(docs.where("doc_id > 0"), RANKS).collect())
    ids = {i: library.encode_ordinary(t or "") for i, t in enumerate(texts) if i}
    assert got == [(i, len(v), sha(" ".join(map(str, v)).encode()), sha((texts[i] or "").encode())) for i, v in ids.items()]
    assert round_trip_digests(docs.limit(0), RANKS).count() == encode_texts(docs.limit(0), RANKS).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode_ids(spark.createDataFrame([([50256],)], "ids array<int>"), RANKS).collect()


# --- whitening ------------------------------------------------------------------------------


def usable(rows):
    for i, v, *_ in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            yield i, tuple(math.floor(256 * float(c)) for c in v)


def check_whitening(got, rows, components=4):
    by_size = {}
    for i, x in usable(rows):
        by_size.setdefault(len(x), []).append((i, x))
    want_rows = 0
    by_id = {}
    for r in got:
        by_id.setdefault(r["id"], []).append(r)
    for size, held in by_size.items():
        fit = sorted({x for _, x in held})
        n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        xs = np.array(fit, float).reshape(n, size) - np.array(sums) / n
        cov = xs.T @ xs / n
        values, vectors = np.linalg.eigh(cov) if size else (np.zeros(0), np.zeros((0, 0)))
        values, vectors = values[::-1], vectors[:, ::-1]
        k = min(components, int((values > 1e-12 * max(values.max(initial=0), 1e-300)).sum()))
        signs = {}
        for i, x in held:
            want_rows += k
            for r in by_id.get(i, []):
                if r["deviation"] != sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)):
                    continue  # another row of a repeated id
                c = r["component"] - 1
                plain = (np.array(x) - np.array(sums) / n) @ vectors[:, c] / math.sqrt(values[c])
                if abs(plain) > 1e-3:
                    signs.setdefault(c, math.copysign(1, plain) * math.copysign(1, r["whitened"]))
                assert r["n"] == n
                assert r["whitened"] * signs.get(c, 1) == pytest.approx(plain, abs=1e-8)
                assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
                assert r["identity_error"] < 1e-9
    assert len(got) == want_rows


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    data = rng.standard_normal((400, 12)) * np.array([3, 2, 1.5, 1.2] + [0.5] * 8)
    rows = [(i, [float(np.float32(c)) for c in v], "x") for i, v in enumerate(data)]
    rows += [(i + 1000, rows[7][1], "hot") for i in range(200)]
    odd = [None, [None] + rows[0][1][1:], [math.nan] + rows[0][1][1:], [math.inf] * 12, []]
    return [*rows, rows[0], *((2000 + i, v, None) for i, v in enumerate(odd)), (3000, [-0.0] * 12, "zero")]


def test_whitening_matches_a_dense_eigensolver(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, n string").repartition(4)
    got = whiten(df).collect()
    check_whitening(got, vectors)
    fit = fit_whitening(df)[12]
    assert np.allclose(fit.components.T @ fit.components, np.eye(4), atol=1e-13)


def test_whitening_of_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    cases = [
        [],
        [(1, None), (2, [])],
        [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])],  # one distinct vector has no variance
        [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0])],
        [(i, [float(i), float(i * i % 7), 2.0]) for i in range(9)] + [(20 + i, [float(i % 3)]) for i in range(5)],
        [(i, [float(i) * 1e6, float(i % 5)]) for i in range(300)],
    ]
    for rows in cases:
        check_whitening(whiten(spark.createDataFrame(rows, kind)).collect(), rows)
    large = whiten(spark.createDataFrame([(1, [1e13]), (2, [-1e13]), (3, [1e300])], kind)).collect()
    assert [(r["id"], r["deviation"]) for r in large] == [(1, None), (2, None)]  # beyond a long; 1e300 is left out


def test_blocks_and_compensated_sums(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 500)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, n string")
    check_whitening(whiten(df, components=3).collect(), vectors, 3)


@pytest.mark.parametrize("size, rank", [(1, 1), (2, 1), (5, 5), (64, 64), (90, 3), (300, 300)])
def test_jacobi_davidson_against_dense(size, rank):
    a = np.random.default_rng(size).standard_normal((size, rank))
    v = a @ a.T / rank
    values, vectors = jacobi_davidson(lambda u: v @ u, size, 4)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    assert np.abs(values - want).max() <= 1e-12 * want[0]
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() <= 1e-12 * want[0]
