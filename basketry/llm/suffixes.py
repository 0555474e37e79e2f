"""Repeated passages: common prefixes from a Burrows-Wheeler transform, by increasing length.

Suffixes that share their first ``LENGTH`` bytes form intervals of the sorted suffixes.  The ends of
these intervals are where the common prefix of neighbours is shorter; they are found by extending
intervals to the left, breadth first: a step from length l to l + 1 finds all ends with a common
prefix of l, and the search stops at ``LENGTH``.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path, stash
from .text import _BYTE_CODE, _POWERS, MULTIPLIER, mix, ragged, release, slices

LENGTH = 50
ANCHOR = 20  # bytes of an anchor; each string of LENGTH bytes has one
CHUNK_BYTES = 8 << 20  # of text, or one text; each chunk sends a piece to each bucket, so large ones keep pieces few
PART_BYTES = 1 << 20  # of a chunk that are worked on at once, or one text
CHUNK_BUCKET = 16 << 20  # bytes of text whose chunks are stored together
ANCHOR_BUCKET = 16 << 20  # bytes of text whose anchors meet in one task
FRAGMENT_BUCKET = 8 << 20  # bytes of fragments that meet in one task
ANSWER = 50_000  # fragments whose answers are written at once, or one piece
TRANSFORM = 150_000  # suffixes of one transform, unless one anchor has more
LEAST_BUCKETS, MOST_BUCKETS = 24, 100_000  # Spark stores no more buckets
_EACH = 32
_SMALL = 16
_STEP = 1 << 13
_LAST = np.iinfo(np.int64).max
_U = np.uint64


def dump(*arrays) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def load(data: bytes) -> tuple:
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))


def window_anchors(data: np.ndarray) -> np.ndarray:
    """Of each string of LENGTH bytes the least hash of its ANCHOR-byte strings."""
    if len(data) < LENGTH:
        return np.zeros(0, _U)
    h, base, width = _BYTE_CODE[data], MULTIPLIER, 1
    four = None
    while width < 16:
        h = h[:-width] * base + h[width:]
        with np.errstate(over="ignore"):
            base, width = base * base, width * 2
        if width == 4:
            four, base_four = h, base
    h = mix(h[: len(data) - ANCHOR + 1] * base_four + four[16 : 16 + len(data) - ANCHOR + 1])
    span = LENGTH - ANCHOR + 1
    width = 1
    while width * 2 <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    rest = span - width
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def fragments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of strings, anchor) of runs of strings of one text with one anchor."""
    anchor = window_anchors(data)
    if not len(anchor):
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(0, _U)
    inside = np.ones(len(anchor), bool)
    for back in range(1, LENGTH):
        cut = offsets[1:-1] - back
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new)
    stops = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~new[1:], [False]])) + 1
    # least hashes crowd at the low end, so they are spread again
    return starts, stops - starts, mix(anchor[starts])


def _packed_order(symbols: np.ndarray) -> np.ndarray:
    """``bounded_order`` of fewer than 2**21 symbols: a key and its place share 64 bits, and such values sort faster."""
    n = len(symbols)
    bits = _U(n.bit_length())
    place = np.arange(n, dtype=_U)
    five = np.zeros(n + 4, _U)
    five[:n] = symbols
    key = five[:n]
    for k in range(1, 5):
        key = (key << _U(8)) | five[k : n + k]
    for shift in (5, 10, 20, LENGTH - 40, 0):
        ranked = np.sort((key << bits) | place)
        order = (ranked & _U((1 << int(bits)) - 1)).astype(np.int64)
        if not shift:
            return order
        ranked >>= bits
        rank = np.zeros(n + LENGTH, _U)
        rank[order] = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]])).astype(_U)
        key = (rank[:n] << bits) | rank[shift : shift + n]


def bounded_order(symbols: np.ndarray) -> np.ndarray:
    """Places in order of the LENGTH symbols from each on; places equal in them in any order."""
    n = len(symbols)
    if n < 1 << 21:
        return _packed_order(symbols)
    key = np.zeros(n + 8, _U)
    key[:n] = symbols
    for width in (1, 2, 4):
        key = (key << _U(8 * width)) | np.concatenate([key[width:], np.zeros(width, _U)])
    key = key[:n]
    for shift in (8, 16, LENGTH - 32, 0):
        order = np.argsort(key)
        if not shift:
            return order
        ranked = key[order]
        rank = np.zeros(n + 64, _U)
        rank[order] = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]])).astype(_U)
        key = (rank[:n] << _U(32)) | rank[shift : shift + n]


class Occurrences:
    """How often each symbol comes in the first p symbols of the transform.

    Counts are kept for every ``_EACH``-th place; the symbols from there on are counted when asked for.
    """

    def __init__(self, transform: np.ndarray, alphabet: int):
        blocks = len(transform) // _EACH + 1
        self.alphabet = alphabet
        self.symbols = np.zeros((blocks, _EACH), transform.dtype)
        self.symbols.ravel()[: len(transform)] = transform
        whole = transform[: (blocks - 1) * _EACH]
        spots = (np.arange(len(whole)) // _EACH + 1) * alphabet + whole
        counts = np.bincount(spots, minlength=blocks * alphabet).reshape(blocks, alphabet)
        self.counts = np.cumsum(counts, axis=0)

    def upto(self, places: np.ndarray) -> np.ndarray:
        block, rest = np.divmod(places, _EACH)
        spots = np.arange(len(places))[:, None] * self.alphabet + self.symbols[block]
        more = np.bincount(spots[np.arange(_EACH) < rest[:, None]], minlength=len(places) * self.alphabet)
        return self.counts[block] + more.reshape(len(places), self.alphabet)


def interval_ends(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether the suffix at each rank differs from the one before in its first LENGTH symbols.

    Symbol 0 separates texts: strings with it are not extended, so ranks of suffixes that reach
    it within LENGTH symbols may go unmarked.
    """
    n = len(symbols)
    before = np.concatenate([[0], symbols])[order]  # the transform: symbol before each suffix
    present = np.flatnonzero(np.bincount(symbols, minlength=256))
    dense = np.zeros(256, np.int64)
    dense[present] = np.arange(len(present))
    has_zero = int(present[0] == 0)
    transform = dense[before]
    occurrences = Occurrences(transform, len(present))
    # rank of the suffix that begins one symbol earlier: suffixes sort by symbol, then by rank
    earlier = np.empty(n, np.int64)
    earlier[np.argsort(transform.astype(np.uint8), kind="stable")] = np.arange(n)
    below = np.concatenate([[0], np.cumsum(np.bincount(dense[symbols], minlength=len(present)))])[:-1]
    ended = np.zeros(n + 1, bool)
    ended[0] = ended[n] = True
    starts_symbol = np.zeros(n + 1, bool)
    starts_symbol[below] = True
    reached, owner = np.zeros(n, bool), np.zeros(n, np.int64)
    lows, highs = np.array([0]), np.array([n])
    for _ in range(LENGTH):
        size = highs - lows
        small = size <= _SMALL
        # small intervals: their suffixes one symbol earlier, in runs of one interval and symbol
        member = ragged(lows[small], size[small])
        interval = np.repeat(np.flatnonzero(small), size[small])
        good = transform[member] >= has_zero
        rank = earlier[member[good]]
        reached[rank], owner[rank] = True, interval[good]
        rank = np.flatnonzero(reached)
        reached[rank] = False
        new = np.ones(len(rank) + 1, bool)
        new[1:-1] = (np.diff(rank) != 1) | (np.diff(owner[rank]) != 0) | starts_symbol[rank[1:]]
        found_low, found_high = [rank[new[:-1]]], [rank[new[1:]] + 1]
        # large intervals: counts of all symbols before and up to them
        wide_low, wide_high = lows[~small], highs[~small]
        for a in range(0, len(wide_low), _STEP):
            first, last = occurrences.upto(wide_low[a : a + _STEP]), occurrences.upto(wide_high[a : a + _STEP])
            row, symbol = np.nonzero(first[:, has_zero:] != last[:, has_zero:])
            symbol += has_zero
            found_low.append(below[symbol] + first[row, symbol])
            found_high.append(below[symbol] + last[row, symbol])
        lows, highs = np.concatenate(found_low), np.concatenate(found_high)
        fresh = ~ended[highs]
        lows, highs = lows[fresh], highs[fresh]
        ended[highs] = True
        if not len(lows):
            break
    return ended[:n]


def least_owner(data: np.ndarray, lengths: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Of each string of LENGTH bytes of some pieces, in order, the least owner of an equal one."""
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    symbols = np.zeros(int((lengths + 1).sum()), np.uint8)
    symbols[ragged(starts, lengths)] = data + 1  # UTF-8 has no byte 0xFF
    order = bounded_order(symbols)
    group = np.cumsum(interval_ends(symbols, order)) - 1
    windows = ragged(starts, lengths - LENGTH + 1)
    own = np.full(len(symbols), _LAST)
    own[windows] = np.repeat(owner, lengths - LENGTH + 1)
    least = np.minimum.reduceat(own[order], np.flatnonzero(np.diff(np.concatenate([[-1], group]))))
    at = np.zeros(len(symbols), np.int64)
    at[order] = least[group]
    return at[windows]


# ---- the jobs -------------------------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in compressed chunks."""
    from pyspark import TaskContext

    base, number = TaskContext.get().partitionId() << 32, 0
    held, size = [], 0

    def flush():
        ids, lengths, data = (np.concatenate(x) for x in zip(*held, strict=True))
        body = dump(ids, np.concatenate([[0], np.cumsum(lengths)]), data)
        return pa.RecordBatch.from_pydict({"chunk": pa.array([base + number], pa.int64()), "body": pa.array([body], pa.binary())})

    for part, data, offsets in slices(batches, "text", CHUNK_BYTES):
        if held and size + len(data) > CHUNK_BYTES:
            yield flush()
            held, size, number = [], 0, number + 1
        ids = part.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
        nulls = np.asarray(part.column(0).is_null())
        held.append((np.stack([ids, nulls.astype(np.int64)], 1), np.diff(offsets), data))
        size += len(data)
    if held:
        yield flush()


def _parts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most PART_BYTES, or one text."""
    at, count = 0, len(offsets) - 1
    while at < count:
        end = max(int(np.searchsorted(offsets, offsets[at] + PART_BYTES, "right")) - 1, at + 1)
        yield at, end
        at = end


def _anchor_rows(buckets: int, width: int):
    """Distinct anchors of a chunk, and whether two of its texts hold them, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _, offsets, data = load(body.as_py())
                anchors, texts = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
                for i, j in _parts(offsets):
                    part = offsets[i : j + 1] - offsets[i]
                    starts, _, anchor = fragments(data[offsets[i] : offsets[j]], part)
                    anchors.append(anchor)
                    texts.append(np.searchsorted(part, starts, "right") - 1 + i)
                anchor, text = np.concatenate(anchors), np.concatenate(texts)
                order = np.argsort(anchor)
                anchor, text = anchor[order], text[order]
                first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
                many = np.minimum.reduceat(text, first) != np.maximum.reduceat(text, first) if len(first) else np.zeros(0, bool)
                anchor = anchor[first]
                cuts = np.searchsorted(_bucket(anchor, buckets), np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts))
                packed = anchor.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(some, pa.int64()),
                        "chunk": pa.array(np.full(len(some), chunk), pa.int64()),
                        "anchors": pa.array([packed[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
                        "many": pa.array([np.packbits(many[cuts[b] : cuts[b + 1]]).tobytes() for b in some], pa.binary()),
                    }
                )

    return run


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the upper 32 bits, so sorted hashes are sorted by bucket."""
    return (((h >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _widen(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(">u8").ravel().astype(_U)


def _repeated(width: int):
    """Of each chunk the anchors that other texts hold as well."""

    def run(table: pa.Table) -> pa.Table:
        release()
        chunks = table["chunk"].to_pylist()
        raw = table["anchors"].to_pylist()
        many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(r) // width).view(bool) for m, r in zip(table["many"].to_pylist(), raw, strict=True)]
        anchors = [_widen(r, width) for r in raw]
        everything = np.concatenate(anchors)
        _, number, count = np.unique(everything, return_inverse=True, return_counts=True)
        again = count > 1
        again[number[np.concatenate(many)]] = True
        kept = np.split(again[number], np.cumsum([len(a) for a in anchors])[:-1])
        out = [(c, dump(a[k])) for c, a, k in zip(chunks, anchors, kept, strict=True) if k.any()]
        n = sum(int(k.sum()) for k in kept)
        return pa.table({"chunk": pa.array([c for c, _ in out], pa.int64()), "body": pa.array([b for _, b in out], pa.binary()), "n": pa.array([n] + [0] * (len(out) - 1) if out else [], pa.int64())})

    return run


def _contents(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of pieces of the data."""
    up, down = _POWERS.upto(len(data))
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=total[1:])
    return mix((total[starts + lengths] - total[starts]) * down[starts] + lengths.astype(_U))


def _fragment_rows(buckets: int, width: int):
    """Distinct fragments of a chunk with repeated anchors, and where they start, by bucket."""
    cut = _U(8 * (8 - width))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        rows = []
        replies = [load(b)[0] for b in right["body"].to_pylist()]
        for chunk, body in zip(left["chunk"].to_pylist(), left["body"].to_pylist(), strict=True):
            if not replies:
                continue
            ids, offsets, data = load(body)
            wanted = np.sort(np.concatenate(replies))
            found = []
            for i, j in _parts(offsets):
                piece = data[offsets[i] : offsets[j]]
                starts, windows, anchor = fragments(piece, offsets[i : j + 1] - offsets[i])
                short = (anchor >> cut) << cut
                place = np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)
                good = wanted[place] == short
                starts, lengths = starts[good], windows[good] + LENGTH - 1
                found.append((starts + offsets[i], lengths, anchor[good], _contents(piece, starts, lengths)))
            starts, lengths, anchor, content = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(starts):
                continue
            text = np.searchsorted(offsets, starts, "right") - 1
            order = np.lexsort((content, anchor))
            new = np.concatenate([[True], (content[order][1:] != content[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])])
            first = np.flatnonzero(new)
            ends = np.append(first[1:], len(order))
            owner = ids[text[order], 0]
            least, most = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
            one = order[first]
            cuts = np.searchsorted(_bucket(anchor[one], buckets), np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                s = slice(cuts[b], cuts[b + 1])
                own = one[s]
                places = starts[order[first[s.start] : ends[s.stop - 1]]]
                piece = data[ragged(starts[own], lengths[own])]
                rows.append((b, chunk, dump((ends - first)[s].astype(np.int32), places.astype(np.int32), anchor[own] >> _U(16), lengths[own].astype(np.int32), least[s], most[s] - least[s], piece)))
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([r[1] for r in rows], pa.int64()), "body": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _match(table: pa.Table) -> pa.Table:
    """Where in each chunk strings begin that a smaller document holds, in runs of one least document."""
    release()
    chunks = table["chunk"].to_pylist()
    parts = [load(b) for b in table["body"].to_pylist()]
    copies, places, anchor, lengths, least, more, piece = zip(*parts, strict=True)
    many = [len(a) for a in anchor]
    anchor, lengths, least, more, data = (np.concatenate(x) for x in (anchor, lengths, least, more, piece))
    lengths, most = lengths.astype(np.int64), least + more
    begins = np.cumsum(lengths) - lengths
    cuts = np.unique(np.searchsorted(begins, np.arange(0, len(data), PART_BYTES)))
    content = np.concatenate([_contents(data[begins[i] : begins[j - 1] + lengths[j - 1]], begins[i:j] - begins[i], lengths[i:j]) for i, j in pairwise([*cuts, len(begins)]) if i < j])
    order = np.lexsort((lengths, content, anchor))
    a, c, n = anchor[order], content[order], lengths[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1])]))
    kind = np.zeros(len(order), np.int64)
    kind[order] = np.cumsum(np.concatenate([[0], np.diff(np.searchsorted(first, np.arange(len(order)), "right"))]))
    owner = np.minimum.reduceat(least[order], first)
    one = order[first]  # a fragment of each kind; kinds are in order of their anchor
    windows = lengths[one] - LENGTH + 1
    window_at = np.cumsum(windows) - windows
    # the only fragment of an anchor: any string of it that comes twice has this one owner
    found = np.repeat(owner, windows)
    new = np.concatenate([[True], anchor[one][1:] != anchor[one][:-1]])
    several = np.flatnonzero(~(new & np.append(new[1:], True)))
    new_anchor = np.flatnonzero(new[several])
    size = np.cumsum(lengths[one[several]] + 1)
    i = 0
    while i < len(several):
        done = size[i - 1] if i else 0
        k = int(np.searchsorted(size, done + TRANSFORM, "right"))
        stops = new_anchor[np.searchsorted(new_anchor, i, "right") :]
        fit = stops[stops <= k]
        j = int(fit[-1]) if len(fit) and k < len(several) else (len(several) if k >= len(several) else int(stops[0]) if len(stops) else len(several))
        kinds = several[i:j]
        own = one[kinds]
        text = data[ragged(begins[own], lengths[own])]
        found[ragged(window_at[kinds], windows[kinds])] = least_owner(text, lengths[own], owner[kinds])
        i = j
    each, starts = np.concatenate(copies), np.concatenate(places)
    start_at = np.cumsum(each) - each
    rows = []
    edges = np.concatenate([[0], np.cumsum(many)])  # fragments before each piece
    p = 0
    while p < len(many):
        q = max(int(np.searchsorted(edges, edges[p] + ANSWER, "right")) - 1, p + 1)
        part = np.arange(edges[p], edges[q])
        own = kind[part]
        w = windows[own]
        value = found[ragged(window_at[own], w)]
        fragment = np.repeat(part, w)
        spot = ragged(np.zeros(len(part), np.int64), w)
        hit = value < np.repeat(most[part], w)
        new = hit.copy()
        new[1:] &= ~hit[:-1] | (value[1:] != value[:-1]) | (fragment[1:] != fragment[:-1])
        runs = np.flatnonzero(new)
        last = hit.copy()
        last[:-1] &= ~hit[1:] | new[1:]
        run = np.flatnonzero(last) + 1 - runs
        fragment = fragment[runs]
        times = each[fragment]  # a fragment may start at several places of the chunk
        begin = (starts[ragged(start_at[fragment], times)] + np.repeat(spot[runs], times)).astype(np.int32)
        run, value = np.repeat(run, times).astype(np.int32), np.repeat(value[runs], times)
        ends = np.concatenate([[0], np.cumsum(times)])[np.searchsorted(fragment, edges[p : q + 1])]
        for chunk, x, y in zip(chunks[p:q], ends[:-1], ends[1:], strict=True):
            if x < y:
                rows.append((chunk, dump(begin[x:y], run[x:y], value[x:y])))
        p = q
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int64()), "body": pa.array([r[1] for r in rows], pa.binary())})


_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a chunk with the removed spans and the bytes that are left."""
    release()
    out: dict[str, list] = {"id": [], "n_bytes": [], "spans": [], "kept": []}
    for body in left["body"].to_pylist():
        ids, offsets, data = load(body)
        depth = np.zeros(len(data) + 1, np.int32)
        answers = [load(answer) for answer in right["body"].to_pylist()]
        if answers:
            begin, run, value = (np.concatenate(x) for x in zip(*answers, strict=True))
            text = np.searchsorted(offsets, begin, "right") - 1
            good = value < ids[text, 0]
            np.add.at(depth, begin[good], 1)
            np.add.at(depth, begin[good] + run[good] + LENGTH - 1, -1)
        gone = np.cumsum(depth[:-1], dtype=np.int32) > 0
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            mask = gone[a:b]
            spans: list[dict] = []
            text = data[a:b]
            if mask.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                spans = [{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                text = text[~mask]
            out["id"].append(None if ids[i, 1] else int(ids[i, 0]))
            out["n_bytes"].append(b - a)
            out["spans"].append(spans)
            out["kept"].append(text.tobytes())
    return pa.table({"id": pa.array(out["id"], pa.int64()), "n_bytes": pa.array(out["n_bytes"], pa.int64()), "spans": pa.array(out["spans"], _ARROW_SPANS), "kept": pa.array(out["kept"], pa.binary())})


def _by_chunk(packed: DataFrame, size: int) -> DataFrame:
    """Chunks stored in buckets by their number, so that joining them twice moves no text.

    Only a table can have buckets.  Its name is dropped at once; the files stay and are read by the plan.
    """
    spark = packed.sparkSession
    path = fresh_path(spark, "repeat-chunks")
    name = f"repeat_chunks_{path.rsplit('-', 1)[-1]}"
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, math.ceil(size / CHUNK_BUCKET)))
    # a chunk is compressed already
    write = packed.write.option("compression", "none").option("path", path)
    write.bucketBy(buckets, "chunk").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept): texts without what a document of a smaller id holds as well.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with a smaller id;
    ``spans`` are the maximal removed runs, ``kept`` the remaining bytes (maybe cut within a character).
    Strings are judged on the input, and do not cross documents.

    Each string of LENGTH bytes has an anchor, the least hash of its 20-byte strings.  Equal strings have equal anchors,
    so only strings whose anchor is in two documents matter.  Texts are cut to fragments, runs of
    strings of one anchor; fragments of an anchor meet in one task, distinct ones once per chunk of texts
    and then once per task, and there the transform of a group of fragments finds the intervals of equal
    strings and their least document.  An anchor with one distinct fragment needs no transform.  What a task holds is bounded by the sizes above: the
    numbers of buckets follow the input.  A text takes about 60 bytes of memory per byte.

    Ids are integers; a null id counts as after all others, equal ids are no smaller than each other, so
    repeated rows do not remove each other.  Null texts are empty.  Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = _by_chunk(rows.mapInArrow(_pack, "chunk long, body binary"), size)
    buckets = max(LEAST_BUCKETS, math.ceil(size / ANCHOR_BUCKET))
    # an anchor is only a filter: so many bytes of it leave few chance meetings
    width = min(8, math.ceil((math.log2(size + 2) + 10) / 8))
    anchors = packed.mapInArrow(_anchor_rows(buckets, width), "bucket long, chunk long, anchors binary, many binary")
    again = stash(anchors.groupBy("bucket").applyInArrow(_repeated(width), "chunk long, body binary, n long"), "repeat-anchors")
    count = again.agg(F.sum("n")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(count * 1.3 * LENGTH / FRAGMENT_BUCKET))
    pieces = packed.groupBy("chunk").cogroup(again.select("chunk", "body").groupBy("chunk"))
    pieces = pieces.applyInArrow(_fragment_rows(buckets, width), "bucket long, chunk long, body binary")
    hits = pieces.groupBy("bucket").applyInArrow(_match, "chunk long, body binary")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])
    return packed.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(_remove, schema)
