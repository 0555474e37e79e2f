"""Spelling variants: words one edit apart, found by products of letter-count blocks."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stash
from .text import slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
HELD_WORDS = 200_000  # distinct words a counting task holds before it passes them on
LETTERS = 96  # columns of a letter-count matrix; letters that share one only add candidates
CLASSES = 6  # classes of letters that name a block
TILE_WORDS = 2048  # words of a tile, so a product has 4 million entries
TILE_LETTERS = 1 << 20  # letters of a tile of long words
VERIFY_LETTERS = 1 << 22  # letters compared at once
_EXACT_IN_SINGLE = 2000  # longest words whose squared counts are whole numbers in single precision


def _counter(drop_every: int | None, least_length: int):
    """A function for mapInArrow from (id, text) to (word, n), each word as often as it is passed on."""

    def rows(total: dict[bytes, int]) -> pa.RecordBatch:
        names = pa.array(list(total), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([names, pa.array(total.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for part, _, _ in slices(batches, "text"):
            for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                before = zlib.crc32(f"{name or ''}:".encode())
                for run, n in Counter(RUN.findall(text)).items():
                    if len(run) < least_length:
                        continue
                    word = run.encode().lower()  # of bytes, so A-Z only
                    if drop_every and not (h := zlib.crc32(word, before)) % drop_every:
                        at = h % len(run)
                        whole = word.decode()
                        if len(run) == least_length:
                            continue
                        word = (whole[:at] + whole[at + 1 :]).encode()
                    total[word] = total.get(word, 0) + n
            if len(total) >= HELD_WORDS:
                yield rows(total)
                total = {}
        yield rows(total)

    return count


def count_words(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    drop_every: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): runs of Latin letters in all texts, A-Z lower-cased, and how often they occur.

    Words of fewer than ``least_length`` code points or ``least_count`` occurrences are left out.
    With ``drop_every``, a run whose crc32 of ``<doc_id>:<run>`` it divides loses the code point
    at that crc32 modulo the run's length: a slip of the pen that is the same on every run.

    Null and empty texts have no words; a null id counts as the empty text; repeated rows count
    as often as they come; other columns are not read; an empty table has no words.  A very long text
    is held whole, with its distinct words, by one task.
    """
    named = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    counted = named.mapInArrow(_counter(drop_every, least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a word in a row."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _histogram(owner: np.ndarray, column: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return np.bincount(owner * columns + column, minlength=rows * columns).reshape(rows, columns)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) with the word's block: how many letters it has of each class."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        lengths = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = _histogram(owner, codes % CLASSES, len(words), CLASSES)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(counts.ravel(), pa.int32()), CLASSES)
        yield pa.RecordBatch.from_arrays([*batch.columns, lists.cast(pa.list_(pa.int32()))], ["word", "n", "block"])


def _squared_distances(a: np.ndarray, b: np.ndarray, kind) -> np.ndarray:
    """Squared distances of the letter counts of all words of ``a`` to all of ``b``, by one product."""
    left, right = a.astype(kind), b.astype(kind)
    out = left @ right.T
    out *= -2
    out += (left * left).sum(1)[:, None]
    out += (right * right).sum(1)
    return out


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of code points differ by one edit; ``b`` is as long or one longer."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(1) == 1
    head = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= length


def near_pairs(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all words of ``a`` and ``b`` one edit apart.

    All words of ``a`` have one length, all of ``b`` the same or one more.  One edit changes the
    letter counts by a squared distance of at most two; such pairs are compared letter by letter.
    """
    p, q = _letters(a, len(a[0])), _letters(b, len(b[0]))
    counts = [
        _histogram(np.repeat(np.arange(len(x)), x.shape[1]), x.ravel().astype(np.int64) % LETTERS, len(x), LETTERS)
        for x in (p, q)
    ]
    kind = np.float32 if q.shape[1] <= _EXACT_IN_SINGLE else np.float64
    i, j = np.nonzero(_squared_distances(*counts, kind) <= 2)
    step = max(1, VERIFY_LETTERS // q.shape[1])
    good = [_one_edit(p[i[k : k + step]], q[j[k : k + step]]) for k in range(0, len(i), step)]
    kept = np.concatenate(good) if good else np.zeros(0, bool)
    return i[kept], j[kept]


def _best(words: list[str], ns: list[int], own: np.ndarray, other: np.ndarray, others: list[str], other_ns: list[int], out: list[list]) -> None:
    """Add (word, number of near words, the best of them and its count) of each word with any."""
    order = sorted(range(len(others)), key=lambda k: (-other_ns[k], others[k]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    counts = np.bincount(own, minlength=len(words))
    best = np.full(len(words), len(order))
    np.minimum.at(best, own, place[other])
    for k in np.flatnonzero(counts).tolist():
        top = order[best[k]]
        for column, value in zip(out, (words[k], int(counts[k]), others[top], other_ns[top]), strict=True):
            column.append(value)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two tiles to what each word's best partner there is; a tile with itself counts once."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("words_a", "ns_a", "words_b", "ns_b", "same")]
        for at in range(batch.num_rows):
            a, na, b, nb, same = (c[at].as_py() for c in columns)
            i, j = near_pairs(a, b)
            if not len(i):
                continue
            out: list[list] = [[], [], [], []]
            _best(a, na, i, j, b, nb, out)
            if not same:  # within a tile every pair comes in both orders
                _best(b, nb, j, i, a, na, out)
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "best", "best_n"])


def _partners(block: str) -> F.Column:
    """The blocks that one edit can lead to, each pair of blocks from one side only.

    An edit leaves the class counts as they are, moves one from a class to another, or adds one.
    """

    def changed(steps: dict[int, int]):
        return F.array(*(F.col(block)[k] + steps.get(k, 0) for k in range(CLASSES)))

    moves = [changed({i: -1, j: 1}) for i in range(CLASSES) for j in range(i + 1, CLASSES)]
    added = [changed({j: 1}) for j in range(CLASSES)]
    return F.array(F.col(block), *moves, *added)


def _tile_pairs(words: DataFrame) -> DataFrame:
    """All pairs of tiles whose words may be one edit apart, with the words of both."""
    length = F.aggregate("block", F.lit(0), lambda n, c: n + c)
    room = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_LETTERS) / length)))
    sizes = words.groupBy("block").agg(F.count(F.lit(1)).alias("_n"))
    sizes = stash(sizes.select("block", F.ceil(F.col("_n") / room).cast("int").alias("tiles")), "spelling-blocks")

    tile = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int").alias("tile")
    tiled = words.join(sizes, "block").groupBy("block", tile).agg(
        F.collect_list("word").alias("words"), F.collect_list("n").alias("ns")
    )
    tiled = stash(tiled, "spelling-tiles")

    one = sizes.select(F.col("block").alias("block_a"), F.col("tiles").alias("tiles_a"))
    led = one.select("*", F.explode(_partners("block_a")).alias("block_b"))
    other = sizes.select(F.col("block").alias("block_b"), F.col("tiles").alias("tiles_b"))
    both = led.join(other, "block_b")
    both = both.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)).alias("tile_a"))
    first = F.when(F.col("block_a") == F.col("block_b"), F.col("tile_a")).otherwise(0)
    both = both.select("block_a", "tile_a", "block_b", F.explode(F.sequence(first, F.col("tiles_b") - 1)).alias("tile_b"))
    same = (F.col("block_a") == F.col("block_b")) & (F.col("tile_a") == F.col("tile_b"))
    for side in "ab":
        held = tiled.toDF(f"block_{side}", f"tile_{side}", f"words_{side}", f"ns_{side}")
        both = both.join(held, [f"block_{side}", f"tile_{side}"])
    return both.select("words_a", "ns_a", "words_b", "ns_b", same.alias("same"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by doubling the steps that are followed.

    Counts at least double from a word to its form, so a chain has 63 steps at most.
    """
    tied = forms.select("word", F.col("form").alias("root"))
    while True:
        on = tied.select(F.col("word").alias("root"), F.col("root").alias("next"))
        tied = stash(tied.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not tied.where("moved").limit(1).count():
            return tied.select("word", "root")
        tied = tied.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with their counts (word, n).

    Words are near if one inserted, deleted or replaced code point makes one the other.  A word's form is
    its near word of largest n (ties: the smallest in code-point order), if that has at least
    ``ratio`` times the word's n; its root is the last word when forms are followed.

    Words are blocked by how many letters of each of six classes they have, which fixes the length too, so
    one edit leads to the same or a few adjacent blocks.  Blocks are cut into tiles by hash, and a
    task multiplies the letter counts of two tiles: memory is bounded by the tile, a large block has more
    tiles, and what leaves a task is a row per word of a tile, not a pair.

    Null and empty words and words of null n are left out; a word that comes in several rows
    counts as one with their sum; other columns are not read; an empty table gives no rows.
    Words of any length are compared: tiles of long words hold fewer.
    """
    known = words.where("length(word) > 0 AND n IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    kept = stash(known.mapInArrow(_blocks, "word string, n long, block array<int>"), "spelling-words")
    found = _tile_pairs(kept).mapInArrow(_compare, "word string, n_near long, best string, best_n long")
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    )
    best_n = -F.col("top.less")
    has_form = best_n >= ratio * F.col("n")
    out = kept.select("word", "n").join(near, "word", "left").select(
        "word",
        F.when(has_form, F.col("top.best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, best_n).alias("form_n"),
    )
    out = stash(out, "spelling-forms")
    roots = _roots(out.where("form IS NOT NULL"))
    out = out.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
