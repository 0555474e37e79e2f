"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import append_columns, mix, per_process, ragged, range_hashes, slices

HELD_BYTES = 64 << 20  # of pieces that a worker remembers
HELD_PIECE = 256  # longest piece that is remembered
KEYS_PER_BUCKET = 4
TRIES = 1024
DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)

# The contractions that the pattern cuts off, by the letters after the apostrophe.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file: base64 and number on each line.

    The file is a vocabulary of some 50,000 tokens, which the driver holds and broadcasts.
    """
    lines = spark.read.text(path).where("value <> ''").collect()
    return {base64.b64decode(a): int(b) for a, b in (line[0].split() for line in lines)}


class PerfectHash:
    """A minimal perfect hash of byte strings: n keys, n slots, one displacement per bucket.

    Keys fall into buckets by one hash.  Buckets are placed from the largest to the smallest: the
    first displacement that sends all keys of a bucket to free slots is kept; a bucket of one key
    takes a free slot directly.  A key is found with one look at its bucket and one at its slot, where
    the key itself is compared, so a string that is no key is known as such.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        lengths = np.array([len(k) for k in keys], np.int64)
        data = np.frombuffer(b"".join(keys), np.uint8)
        ends = np.cumsum(lengths)
        hashes = range_hashes(data, ends - lengths, ends)
        if len(np.unique(hashes)) != n:
            raise ValueError("two keys have the same 64-bit hash")
        self.buckets = max(1, n // KEYS_PER_BUCKET)
        bucket = self._bucket(hashes)
        by_bucket = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        first = np.cumsum(counts) - counts
        self.displacement = np.zeros(self.buckets, np.int64)
        slot_of = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        for b in np.argsort(-counts, kind="stable").tolist():
            if counts[b] < 2:
                break
            own = by_bucket[first[b] : first[b] + counts[b]]
            slots = self._displace(hashes[own], free)
            self.displacement[b], places = slots
            slot_of[own] = places
            free[places] = False
        single = np.flatnonzero(counts == 1)
        places = np.flatnonzero(free)[: len(single)]
        self.displacement[single] = -1 - places
        slot_of[by_bucket[first[single]]] = places
        key_at = np.empty(n, np.int64)
        key_at[slot_of] = np.arange(n)
        self.key_at, self.hash_at = key_at, hashes[key_at]
        self.data, self.starts, self.lengths = data, ends - lengths, lengths

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> _U(32)) % _U(self.buckets)).astype(np.int64)

    @staticmethod
    def _slots(hashes: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
        return (mix(hashes + (displacement.astype(_U) + _U(1)) * _STEP) % _U(n)).astype(np.int64)

    def _displace(self, hashes: np.ndarray, free: np.ndarray) -> tuple[int, np.ndarray]:
        start = 0
        while True:
            tried = np.arange(start, start + TRIES)
            slots = self._slots(hashes[None, :], tried[:, None], len(free))
            good = free[slots].all(1)
            ordered = np.sort(slots, axis=1)
            good &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
            if good.any():
                at = int(np.argmax(good))
                return start + at, slots[at]
            start += TRIES

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of the key that each byte range is, or -1."""
        out = np.full(len(starts), -1, np.int64)
        if not len(starts) or not len(self.key_at):
            return out
        hashes = range_hashes(data, starts, ends)
        d = self.displacement[self._bucket(hashes)]
        slots = np.where(d < 0, -1 - d, self._slots(hashes, np.maximum(d, 0), len(self.key_at)))
        keys = self.key_at[slots]
        lengths = ends - starts
        like = np.flatnonzero((self.hash_at[slots] == hashes) & (self.lengths[keys] == lengths))
        if len(like):  # equal hashes are not yet equal bytes
            keys, lengths = keys[like], lengths[like]
            same = data[ragged(starts[like], lengths)] == self.data[ragged(self.starts[keys], lengths)]
            equal = np.logical_and.reduceat(same, np.cumsum(lengths) - lengths)
            out[like[equal]] = keys[equal]
        return out


_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


def _classes() -> np.ndarray:
    """Class of every code point that the pattern tells apart, as the library's own patterns see it.

    Tables of letters and numbers differ between versions of Unicode, so they are asked from the library
    whose results are to be met: with single bytes as tokens, it gives back what a pattern matches.
    """
    import tiktoken

    table = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        asked = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(asked.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places where pre-tokens begin, and how many each text has.

    The pattern's matches cover a text, so pre-tokens are told by their beginnings: where the class of
    characters changes, with three rules.  The last of several white-space characters before other ones stands
    alone; if it is a space it belongs to what follows.  A contraction is cut off where
    a pre-token begins with it.  No pre-token runs over the end of a text.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    places = np.flatnonzero((data & 0xC0) != 0x80)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = per_process(("bpe-classes",), _classes)[codes]
    n = len(codes)
    firsts = np.searchsorted(places, offsets[:-1][offsets[:-1] < len(data)])
    first = np.zeros(n + 1, bool)
    first[firsts] = first[n] = True
    begins = np.ones(n + 1, bool)
    begins[1:n] = kind[1:] != kind[:-1]
    begins |= first
    after = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~first[1:n]) + 1
    begins[after - 1] = True
    begins[after[codes[after - 1] == 0x20]] = False

    marks = np.flatnonzero((codes == 0x27) & begins[:n])
    padded = np.concatenate([codes, np.zeros(2, np.uint32)])
    ends_text = np.concatenate([first, [True, True]])
    for tail in CONTRACTIONS:
        here = marks
        for k, letter in enumerate(tail, 1):
            here = here[(padded[here + k] == ord(letter)) & ~ends_text[here + k]]
        begins[here + 1] = False
        begins[here + 1 + len(tail)] = True
    at = np.flatnonzero(begins[:n])
    starts = places[at]
    return starts, np.diff(np.searchsorted(starts, offsets))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one piece: the pair of least rank is merged first, the leftmost of equals.

    Parts are linked in order; the heap holds (rank, start, end) of pairs of parts, and a pair that is
    no longer there is passed over when it comes up, so a piece of n bytes takes n log n steps.
    """
    n = len(piece)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = following[start]
        if not alive[start] or middle >= end or following[middle] != end:
            continue
        alive[middle] = False
        following[start] = end
        if end < n:
            before[end] = start
            far = following[end]
            if (r := ranks.get(piece[start:far])) is not None:
                heapq.heappush(heap, (r, start, far))
        if (back := before[start]) >= 0 and (r := ranks.get(piece[back:end])) is not None:
            heapq.heappush(heap, (r, back, end))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : following[at]]])
        at = following[at]
    return out


class _Misses(dict):
    """Numbers of the pieces that are no token, and the ids of each by number."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.size = 0
        self.flat, self.ends = array("q"), array("q", [0])

    def __missing__(self, piece: bytes) -> int:
        number = len(self.ends) - 1
        ids = merge(piece, self.ranks)
        self.flat.extend(ids)
        self.ends.append(len(self.flat))
        self.size += len(piece) + 8 * len(ids) + 100
        if len(piece) <= HELD_PIECE:
            self[piece] = number
        return number


class ByteBPE:
    """Vocabulary of a byte-level BPE with both tiers; made once, its parts are sent to executors.

    ``ranks`` are the tokens and their ids, all 256 bytes among them.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = sorted(ranks, key=ranks.get)
        self.ids = np.array([ranks[t] for t in self.tokens], np.int64)
        self.table = PerfectHash(self.tokens)

    def parts(self) -> tuple:
        """What a worker needs, as plain values."""
        return self.tokens, self.ids, vars(self.table)

    @classmethod
    def of_parts(cls, parts: tuple) -> ByteBPE:
        self, table = cls.__new__(cls), PerfectHash.__new__(PerfectHash)
        self.tokens, self.ids, state = parts
        vars(table).update(state)
        self.table = table
        return self

    @cached_property
    def _misses(self) -> _Misses:
        return _Misses(dict(zip(self.tokens, self.ids.tolist(), strict=True)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        misses = self._misses
        if misses.size > HELD_BYTES:
            misses.reset()
        starts, pieces = split(data, offsets)
        ends = np.append(starts[1:], len(data))
        found = self.table.find(data, starts, ends)
        rest = np.flatnonzero(found < 0)
        lengths = np.ones(len(starts), np.int64)
        raw = data.tobytes()
        spans = zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)
        numbers = np.fromiter((misses[raw[a:b]] for a, b in spans), np.int64, len(rest))
        upto, flat = np.array(misses.ends), np.array(misses.flat)
        lengths[rest] = upto[numbers + 1] - upto[numbers]
        firsts = np.cumsum(lengths) - lengths
        ids = np.empty(int(lengths.sum()), np.int64)
        hit = np.flatnonzero(found >= 0)
        ids[firsts[hit]] = self.ids[found[hit]]
        ids[ragged(firsts[rest], lengths[rest])] = flat[ragged(upto[numbers], lengths[rest])]
        total = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(pieces)])]
        return ids, np.diff(total)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all id lists one after another, and the offsets of each list's bytes."""
        place = np.searchsorted(self.ids, ids)
        known = place < len(self.ids)
        known[known] = self.ids[place[known]] == ids[known]
        if not known.all():
            raise ValueError(f"id {ids[~known][0]} is not in the vocabulary")
        lengths = self.table.lengths[place]
        data = self.table.data[ragged(self.table.starts[place], lengths)]
        return data, np.concatenate([[0], np.cumsum(lengths)])[offsets]


def _coder(shared, key: str) -> ByteBPE:
    return per_process(("bpe", key), lambda: ByteBPE.of_parts(shared.value))


def encoder(shared, key: str, text: str, out: str):
    """A function for mapInArrow that adds column ``out`` with the ids of ``text``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, key)
        for part, data, offsets in slices(batches, text):
            ids, counts = coder.encode(data, offsets)
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32), pa.int32()))
            yield append_columns(part, {out: lists})

    return encode


def decoder(shared, key: str, ids: str, out: str):
    """A function for mapInArrow that adds column ``out`` with the bytes of the lists ``ids``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, key)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).cast(pa.list_(pa.int64()))
            lengths = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            flat = np.asarray(lists.flatten(), np.int64)
            data, offsets = coder.decode(flat, np.concatenate([[0], np.cumsum(lengths)]))
            ends = pa.py_buffer(offsets.astype(np.int64))
            values = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, ends, pa.py_buffer(data)])
            yield append_columns(batch, {out: values.cast(pa.binary())})

    return decode


def broadcast_bpe(spark: SparkSession, ranks_path: str):
    """The vocabulary with its perfect hash, some 2 MB for 50,000 tokens, on every executor."""
    return spark.sparkContext.broadcast(ByteBPE(read_ranks(spark, ranks_path)).parts())


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    # names are compared as they are written, as append_columns does
    kept = [f for f in df.schema.fields if f.name != name]
    return T.StructType([*kept, T.StructField(name, kind)])


def encode_texts(docs: DataFrame, ranks_path: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows with an array ``ids``: the token ids of the whole text.

    A text is cut into pre-tokens.  Those that are tokens are found by a minimal perfect hash, all of
    a slice of texts at once; the others are merged pair by pair with a heap, and a worker remembers the short ones
    up to a bound.  Special tokens are ordinary text.  The vocabulary must hold all 256 bytes.

    Null and empty texts have no ids; repeated rows are rows of their own; a column named as the result
    gives way; an empty table stays empty.  A very long text is held whole by one task, at about
    100 bytes of memory per byte.
    """
    shared = broadcast_bpe(docs.sparkSession, ranks_path)
    return docs.mapInArrow(encoder(shared, ranks_path, text, ids), _schema(docs, ids, T.ArrayType(T.IntegerType())))


def decode_ids(rows: DataFrame, ranks_path: str, *, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """All rows with the bytes of their token ids; a null list has none, an unknown id raises."""
    shared = broadcast_bpe(rows.sparkSession, ranks_path)
    return rows.mapInArrow(decoder(shared, ranks_path, ids, out), _schema(rows, out, T.BinaryType()))


def round_trip_digests(docs: DataFrame, ranks_path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): texts encoded, their ids decoded, and digests of both.

    Encoding, decoding and hashing follow each other in one pass over the texts, so neither ids nor bytes leave
    the worker.  Nulls, repeated rows, long texts and empty tables are as in ``encode_texts``.
    """
    shared = broadcast_bpe(docs.sparkSession, ranks_path)
    encode, decode = encoder(shared, ranks_path, "text", "ids"), decoder(shared, ranks_path, "ids", "bytes")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(map(str, range(int(shared.value[1].max()) + 1)))
        for batch in decode(encode(batches)):
            lists = batch.column(batch.schema.get_field_index("ids"))
            ids, ends = np.asarray(lists.values).tolist(), np.asarray(lists.offsets).tolist()
            written = (" ".join([names[i] for i in ids[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True))
            first = [hashlib.sha256(w.encode()).hexdigest() for w in written]
            held = batch.column(batch.schema.get_field_index("bytes"))
            second = [hashlib.sha256(b.as_buffer()).hexdigest() for b in held]
            arrays = [batch.column(batch.schema.get_field_index("id")), pa.array(np.diff(ends), pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(first), pa.array(second)], ["id", *DIGESTS])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kinds = [T.LongType(), T.StringType(), T.StringType()]
    fields = [T.StructField("id", rows.schema["id"].dataType)]
    fields += [T.StructField(n, k) for n, k in zip(DIGESTS, kinds, strict=True)]
    return rows.mapInArrow(digests, T.StructType(fields))
