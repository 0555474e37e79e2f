"""Benchmark decontamination: a prefix-filtered join of item windows with document words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash
from .text import MULTIPLIER, mix, ragged, slices, utf8, words

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 200_000  # about 40 MB in a task
BLOCKS_AT_ONCE = 2
_BITS = 22

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_ARROW_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_ARROW_SPAN)), ("items", pa.list_(pa.string()))])


@dataclass
class Block:
    """Distinct windows of some items.

    ``grid`` has the word hashes of a window in a row, 0 after its ``length``.  Its shingles are the
    word ``SHINGLE``-grams (all its words if it has fewer): ``tokens`` are their distinct hashes and
    ``arity`` their numbers of words.  ``spots`` has (token, window, offset) rows.
    """

    grid: np.ndarray
    length: np.ndarray
    owners: list[set[str]]
    tokens: np.ndarray
    arity: np.ndarray
    spots: np.ndarray

    def bitmap(self, tokens: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << _BITS, bool)
        bits[tokens >> np.uint64(64 - _BITS)] = True
        return bits


def make_block(items: list[tuple[str, np.ndarray]], window: int) -> Block:
    """items: id as text and word hashes."""
    seen: dict[bytes, int] = {}
    owners: list[set[str]] = []
    rows: list[np.ndarray] = []
    for name, hashes in items:
        for at in range(max(1, len(hashes) - window + 1)):
            row = hashes[at : at + window]
            number = seen.setdefault(row.tobytes(), len(rows))
            if number == len(rows):
                rows.append(row)
                owners.append(set())
            owners[number].add(name)
    length = np.array([len(r) for r in rows], np.int64)
    grid = np.zeros((len(rows), window), np.uint64)
    for i, r in enumerate(rows):
        grid[i, : len(r)] = r
    spots = []
    for n in range(1, window + 1):
        own = np.flatnonzero(length == n)
        if not len(own):
            continue
        k = min(SHINGLE, n)
        for at in range(n - k + 1):
            spots.append((_shingle(grid[own, at : at + k]), np.full(len(own), k), own, np.full(len(own), at)))
    h, k, w, o = (np.concatenate(x) for x in zip(*spots, strict=True))
    tokens, first, number = np.unique(h, return_index=True, return_inverse=True)
    return Block(grid, length, owners, tokens, k[first], np.stack([number, w, o], 1))


def _shingle(columns: np.ndarray) -> np.ndarray:
    h = columns[:, 0].copy()
    for k in range(1, columns.shape[1]):
        h = h * MULTIPLIER + columns[:, k]
    return mix(h)


def _token_places(found, block: Block, wanted: np.ndarray, bits: np.ndarray):
    """(place, index into wanted) of all wanted tokens in the words of some texts."""
    for k in np.unique(block.arity):
        h, inside = found.shingles(int(k))
        places = np.flatnonzero(bits[h >> np.uint64(64 - _BITS)] & inside)
        index = np.searchsorted(wanted, h[places])
        index[index == len(wanted)] = 0
        good = wanted[index] == h[places]
        yield places[good], index[good]


def _counter(text: str, block):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Block(**block.value)
        bits, total = b.bitmap(b.tokens), np.zeros(len(b.tokens), np.int64)
        for _, data, offsets in slices(batches, text):
            for _, index in _token_places(words(data, offsets), b, b.tokens, bits):
                total += np.bincount(index, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"token": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

    return count


def _prefixes(block: Block, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rarest token of each window: its hash, window and offset, by hash."""
    token, window, offset = block.spots.T
    order = np.lexsort((offset, token, counts[token], window))
    first = order[np.concatenate([[True], np.diff(window[order]) > 0])]
    first = first[np.argsort(token[first], kind="stable")]
    return block.tokens[token[first]], window[first], offset[first]


def _matcher(text: str, target: str, block, prefixes):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, (hashes, window, offset) = Block(**block.value), prefixes.value
        wanted, first = np.unique(hashes, return_index=True)
        many = np.diff(np.concatenate([first, [len(hashes)]]))
        bits = b.bitmap(wanted)
        for part, data, offsets in slices(batches, text):
            found = words(data, offsets)
            ends = np.repeat(found.first[1:], found.counts)
            begins = np.repeat(found.first[:-1], found.counts)
            hits: list[np.ndarray] = []
            for places, index in _token_places(found, b, wanted, bits):
                rows = ragged(first[index], many[index])
                at = np.repeat(places, many[index])
                w = window[rows]
                start = at - offset[rows]
                # positional bound: the window starts in the text; length bound: it ends there
                fits = (start >= begins[at]) & (start + b.length[w] <= ends[at])
                start, w = start[fits], w[fits]
                same = np.ones(len(w), bool)
                for k in range(b.grid.shape[1]):
                    more = np.flatnonzero(same & (b.length[w] > k))
                    same[more] = found.hashes[start[more] + k] == b.grid[w[more], k]
                hits.append(np.stack([start[same], w[same]], 1))
            before = part.column(part.schema.get_field_index(target)).to_pylist()
            results = _results(found, np.concatenate(hits), b, before)
            columns = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n != target]
            names = [n for n in part.schema.names if n != target]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(results, _ARROW)], [*names, target])

    return match


def _results(found, hits: np.ndarray, block: Block, before: list[dict | None]) -> list[dict]:
    """What earlier blocks found and this one, per text."""
    out = [{"n_words": int(n), "spans": [], "items": []} for n in found.counts]
    start, window = hits.T
    text = np.searchsorted(found.first, start, "right") - 1
    order = np.argsort(text, kind="stable")
    touched, first = np.unique(text[order], return_index=True)
    groups = dict(zip(touched.tolist(), np.split(order, first[1:]), strict=True)) if len(order) else {}
    for i, row in enumerate(out):
        old = before[i]
        own = groups.get(i)
        if own is None:
            if old is not None:
                row |= {"spans": old["spans"], "items": old["items"]}
            continue
        hit = np.zeros(row["n_words"] + 1, np.int64)
        a = start[own] - found.first[i]
        np.add.at(hit, a, 1)
        np.add.at(hit, a + block.length[window[own]], -1)
        for s in (old or {}).get("spans") or []:
            hit[s["start"]] += 1
            hit[s["end"]] -= 1
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(hit)[:-1] > 0).view(np.int8), [0]])))
        row["spans"] = [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2], strict=True)]
        names = {n for w in np.unique(window[own]).tolist() for n in block.owners[w]}
        row["items"] = sorted(names | set((old or {}).get("items") or []))
    return out


def _blocks(items: DataFrame, window: int, most: int) -> Iterator[Block]:
    """Windows of the items, some at a time; the driver never holds more than one block."""
    held: list[tuple[str, np.ndarray]] = []
    count = 0
    for name, text in items.toLocalIterator():
        data, offsets = utf8(pa.array([text], pa.string()))
        hashes = words(data, offsets).hashes
        if not len(hashes):
            continue
        step = max(window, most)
        for at in range(0, max(1, len(hashes) - window + 1), step):  # a very long item in parts
            held.append((name or "", hashes[at : at + step + window - 1]))
            count += min(step, max(1, len(hashes) - window + 1 - at))
            if count >= most:
                yield make_block(held, window)
                held, count = [], 0
    if held:
        yield make_block(held, window)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
    result: str = "contamination",
) -> DataFrame:
    """All rows with a struct ``result``: number of words, hit spans of words, items.

    A window is ``window`` consecutive words of an item, or all words of a shorter one.  It is a set
    of word 3-grams; they are ordered by how often they come in all documents, and as all of them
    must be in a text that holds the window, the rarest one is the necessary prefix.  Only texts
    places with that token are candidates.  The token's offset bounds where the window starts, its length
    where it ends; then the words are compared one by one (by 64-bit hash).

    The benchmark is the query set: it is taken in blocks of ``block_windows`` windows, each
    broadcast, so what a task holds does not grow with it.  Documents are not shuffled.

    Null texts and texts without words have no words and no hits; an item without words has
    no window; a null item id counts as the empty text; items of one id count as one.  Repeated
    rows are rows of their own.  A column named as the result gives way.  Empty tables are fine.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() != result.lower()]
    out = docs.select(*(f"`{c}`" for c in names))
    out = out.withColumn(result, F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast(T.ArrayType(SPAN)).alias("spans"), F.array().cast("array<string>").alias("items")))
    schema = out.schema[: len(names)].add(T.StructField(result, RESULT))
    chosen = items.select(F.col(item_id).cast("string"), F.col(item_text))
    number = 0
    for number, block in enumerate(_blocks(chosen, window, block_windows), 1):
        shared = spark.sparkContext.broadcast(vars(block))
        counted = docs.select(F.col(text).alias("text")).mapInArrow(_counter("text", shared), "token long, n long")
        counts = np.zeros(len(block.tokens), np.int64)
        for token, n in counted.groupBy("token").agg(F.sum("n")).collect():  # a row per token of the block at most
            counts[token] = n
        prefixes = spark.sparkContext.broadcast(_prefixes(block, counts))
        if number > 1 and number % BLOCKS_AT_ONCE == 1:
            out = stash(out, "decontamination")
        out = out.mapInArrow(_matcher(text, result, shared, prefixes), schema)
    return out if number else out.mapInArrow(_lengths(text, result), schema)


def _lengths(text: str, target: str):
    """No windows at all: only the words are counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, text):
            out = [{"n_words": int(n), "spans": [], "items": []} for n in words(data, offsets).counts]
            columns = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n != target]
            names = [n for n in part.schema.names if n != target]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, _ARROW)], [*names, target])

    return count
