"""Chunks and transforms of `op4_repeated_passages`, called in this process."""

import numpy as np
import pyarrow as pa
import pytest
from basketry.llm import suffixes


def letters(n, seed, of=26):
    return np.random.default_rng(seed).integers(97, 97 + of, n).astype(np.uint8)


def chunk_of(number, ids, texts):
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    body = suffixes.dump(np.array([[i, 0] for i in ids], np.int64), offsets, np.concatenate(texts))
    return {"chunk": number, "body": body}


def pieces_of(chunks):
    """Pieces of all fragments of the chunks, in one bucket."""
    left = pa.Table.from_pylist(chunks, pa.schema([("chunk", pa.int64()), ("body", pa.binary())]))
    found = [suffixes.fragments(data, offsets)[2] for _, offsets, data in (suffixes.load(c["body"]) for c in chunks)]
    wanted = pa.table({"chunk": [c["chunk"] for c in chunks][:1], "body": [suffixes.dump(np.concatenate(found))]})
    return pa.concat_tables([suffixes._fragment_rows(1, 8)(left.slice(i, 1), wanted) for i in range(len(chunks))])


def answers(table):
    return {c: [a.tolist() for a in suffixes.load(b)] for c, b in zip(table["chunk"].to_pylist(), table["body"].to_pylist(), strict=True)}


def test_copies_need_no_transform(monkeypatch):
    text = letters(3000, 1)
    chunks = [chunk_of(0, [5, 6], [text, letters(500, 2)]), chunk_of(1, [9], [text])]

    def refuse(*_):
        raise AssertionError("a transform of one distinct fragment")

    monkeypatch.setattr(suffixes, "least_owner", refuse)
    got = answers(suffixes._match(pieces_of(chunks)))
    begin, run, value = got.pop(1)
    assert not got
    assert sorted(p for b, r in zip(begin, run, strict=True) for p in range(b, b + r)) == list(range(3000 - 49))
    assert set(value) == {5}


def test_a_few_megabytes_of_a_task_are_one_chunk(spark):
    rows = spark.createDataFrame([(i, "x" * 900_000) for i in range(6)], "id long, text string").coalesce(1)
    assert rows.mapInArrow(suffixes._pack, "chunk long, body binary").count() == 1


@pytest.mark.parametrize("limit", [1, 700, 1 << 20])
def test_parts_of_a_chunk_give_what_the_whole_gives(monkeypatch, limit):
    shared = letters(400, 3)
    texts = [np.concatenate([letters(n, 10 + n), shared[n:], letters(40, 50 + n)]) for n in (0, 30, 90, 200)]
    texts += [letters(0, 1), letters(20, 1), texts[1].copy(), letters(300, 7, of=2), np.full(200, 97, np.uint8)]
    chunks = [chunk_of(0, [4, 2, 8, 3, 9], texts[:5]), chunk_of(1, [7, 1, 6, 5], texts[5:])]
    batch = pa.RecordBatch.from_pylist(chunks)
    whole = [b.to_pydict() for b in suffixes._anchor_rows(3, 8)(iter([batch]))], answers(suffixes._match(pieces_of(chunks)))
    monkeypatch.setattr(suffixes, "PART_BYTES", limit)
    monkeypatch.setattr(suffixes, "ANSWER", limit)
    assert ([b.to_pydict() for b in suffixes._anchor_rows(3, 8)(iter([batch]))], answers(suffixes._match(pieces_of(chunks)))) == whole


@pytest.mark.parametrize("symbols", [letters(3000, 4, of=2), np.full(500, 98, np.uint8), letters(1, 5)])
def test_places_are_ordered_by_their_next_symbols(symbols):
    order = suffixes.bounded_order(symbols)
    strings = [bytes(symbols[i : i + 50]) for i in range(len(symbols))]
    assert [strings[i] for i in order] == sorted(strings)
