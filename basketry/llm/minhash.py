"""Near-duplicate texts: consistent weighted sampling of TF-IDF shingles, banded and verified."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash
from .components import merged
from .rows import pack, unpack
from .text import Words, mix, per_process, ragged, slices, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
SKETCH_BITS = 22
FREQUENT_BITS = 18  # a shingle is frequent from (all shingles) / 2**FREQUENT_BITS occurrences on
BLOCKS = 16
LEADER_ROUNDS = 3
WIDE = 64  # nodes; larger buckets are compared block by block
BLOCK_NODES, BLOCK_BYTES = 512, 4 << 20
_TABLE_BITS = 16
_CHUNK = 1 << 15


def document_shingles(found: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of the distinct shingles of each text, in order of text and hash.

    A text of fewer than n words, but not none, has one shingle of all its words.
    """
    h, inside = found.shingles(n)
    place = np.flatnonzero(inside)
    hashes, owners = [h[place]], [found.owner()[place]]
    for k in range(1, n):
        short = np.flatnonzero(found.counts == k)
        if len(short):
            hashes.append(found.shingles(k)[0][found.first[short]])
            owners.append(short)
    h, owner = np.concatenate(hashes), np.concatenate(owners).astype(np.int32)
    order = np.argsort(h)
    order = order[np.argsort(owner[order], kind="stable")]
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return owner[first], h[first], np.diff(np.concatenate([first, [len(h)]]))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of shingles per hash bucket, in compressed blocks; and the number of all."""
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    texts = 0
    for part, data, offsets in slices(batches, "text"):
        _, h, count = document_shingles(words(data, offsets))
        np.add.at(total, (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), count)
        texts += part.num_rows
    blocks = [zlib.compress(b.tobytes(), 1) for b in np.split(total.astype(np.uint32), BLOCKS)] if texts else []
    sums = [int(b.sum()) for b in np.split(total, BLOCKS)] if texts else []
    yield pa.RecordBatch.from_pydict(
        {"block": pa.array(range(len(blocks)), pa.int32()), "counts": pa.array(blocks, pa.binary()), "n": pa.array(sums, pa.int64()), "texts": pa.array([texts if i == 0 else 0 for i in range(len(blocks))], pa.int64())}
    )


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the blocks of one task; rows of a block may come from several such tasks."""
    total: dict[int, np.ndarray] = {}
    n: dict[int, int] = {}
    texts: dict[int, int] = {}
    for batch in batches:
        for b, raw, k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.int64)
            total[b] = total[b] + counts if b in total else counts
            n[b], texts[b] = n.get(b, 0) + k, texts.get(b, 0) + t
    order = sorted(total)
    yield pa.RecordBatch.from_pydict(
        {"block": pa.array(order, pa.int32()), "counts": pa.array([zlib.compress(np.minimum(total[b], 2**32 - 1).astype(np.uint32).tobytes(), 1) for b in order], pa.binary()), "n": pa.array([n[b] for b in order], pa.int64()), "texts": pa.array([texts[b] for b in order], pa.int64())}
    )


_BLOCK_ROWS = "block int, counts binary, n long, texts long"


def _candidate_counter(hot):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(hot.value, np.uint8)).view(bool)
        found = []
        for _, data, offsets in slices(batches, "text"):
            _, h, _ = document_shingles(words(data, offsets))
            found.append(h[bits[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]])
            if len(found) > 64:
                yield _counted(found)
                found = []
        yield _counted(found)

    return count


def _counted(found: list[np.ndarray]) -> pa.RecordBatch:
    h, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
    return pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64), pa.int64()), "n": pa.array(n, pa.int64())})


def damped(total: int, frequency):
    """Inverse document frequency from 1 to 2, by a shingle's share of all occurrences of shingles.

    It is 1 plus -log2(frequency / total) / ``FREQUENT_BITS``, and 2 for any share of 2**-``FREQUENT_BITS`` or less:
    only the share matters, so a table twice as large with the same mix of texts weighs its shingles alike.

    Near copies raise the frequency of what they share.  If idf could fall to nothing, the few words
    in which a large group's texts differ would outweigh the rest, and the group would fall apart.
    """
    return 1 + np.clip(np.log2(total / np.asarray(frequency, np.float64)) / FREQUENT_BITS, 0.0, 1.0)


def inverse_document_frequencies(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """(hash, idf) of frequent shingles, and the idf of all others, from all texts.

    The idf (see ``damped``) is the same for all shingles of at most f = (all occurrences) / 2**18 documents,
    so only those of more, at most 2**18 however many texts, are counted one by one; where f is below 2, those of 2
    or more, and the others come once.  So every shingle has its exact idf.  A sketch of 2**22
    bucket counts first tells in which buckets frequent ones can be (no frequent one is
    missed); shingles of those buckets are then counted exactly.
    """
    spark = texts.sparkSession
    first = texts.mapInArrow(_sketch, _BLOCK_ROWS).repartition("block", F.pmod(F.xxhash64("counts"), F.lit(4)))
    sums = first.mapInArrow(_add_blocks, _BLOCK_ROWS).repartition("block").mapInArrow(_add_blocks, _BLOCK_ROWS)
    sums = sums.toArrow().to_pydict()  # 2**22 counts in all, compressed
    total = sum(sums["n"])
    least = max(2, total / (1 << FREQUENT_BITS))
    hot = np.zeros(1 << SKETCH_BITS, bool)
    step = (1 << SKETCH_BITS) // BLOCKS
    for b, raw in zip(sums["block"], sums["counts"], strict=True):
        hot[b * step : (b + 1) * step] = np.frombuffer(zlib.decompress(raw), np.uint32) >= least
    rest = float(damped(total, max(1, total / (1 << FREQUENT_BITS)))) if total else 1.0
    shared = spark.sparkContext.broadcast(np.packbits(hot).tobytes())
    counted = texts.mapInArrow(_candidate_counter(shared), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= F.lit(float(least))).toArrow()
    h = np.asarray(frequent["h"]).view(np.uint64)
    order = np.argsort(h)
    return h[order], damped(total, np.asarray(frequent["n"])[order]), rest


def weigh(h: np.ndarray, count: np.ndarray, idf: tuple) -> np.ndarray:
    hashes, values, rest = idf
    weight = np.full(len(h), rest)
    if len(hashes):
        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        same = hashes[place] == h
        weight[same] = values[place[same]]
    return weight * count


class Sampler:
    """Improved consistent weighted sampling: one (shingle, level) per seed and text.

    The gamma and uniform variables of a shingle and seed come from 16 bits each of a hash.
    """

    def __init__(self):
        n = 1 << _TABLE_BITS
        p, x = (np.arange(n) + 0.5) / n, np.full(n, 2.0)
        low, high = np.zeros(n), np.full(n, 40.0)
        for _ in range(60):  # quantiles of Gamma(2, 1) by bisection
            x = (low + high) / 2
            below = 1 - (1 + x) * np.exp(-x) < p
            low, high = np.where(below, x, low), np.where(below, high, x)
        self.gamma = x.astype(np.float32)
        self.log_gamma = np.log(x).astype(np.float32)
        self.seeds = np.random.default_rng(99).integers(1, 1 << 63, BANDS * ROWS).astype(np.uint64)

    def sample(self, owner: np.ndarray, h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with shingles, and for each of them the samples of all seeds (32 bits each)."""
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        out = np.zeros((len(starts), len(self.seeds)), np.uint64)
        log_weight = np.log(weight).astype(np.float32)
        mask = np.uint64((1 << _TABLE_BITS) - 1)
        name = (h >> np.uint64(40)) << np.uint64(8)
        best = np.zeros(len(h), np.uint64)
        for k, seed in enumerate(self.seeds):
            for a in range(0, len(h), _CHUNK):
                s = slice(a, a + _CHUNK)
                z = mix(h[s] ^ seed)
                r = self.gamma[z & mask]
                beta = ((z >> np.uint64(32)) & mask).astype(np.float32) * np.float32(2.0**-_TABLE_BITS)
                level = np.floor(log_weight[s] / r + beta)
                key = self.log_gamma[(z >> np.uint64(16)) & mask] - r * (level - beta + 1)
                rank = ((np.clip(key, -63, 63) + 64).astype(np.float64) * 2**25).astype(np.uint64)
                best[s] = (rank << np.uint64(32)) | name[s] | (level.astype(np.int64) & 0xFF).astype(np.uint64)
            out[:, k] = np.minimum.reduceat(best, starts) if len(starts) else 0
        return owner[starts], out & np.uint64(0xFFFFFFFF)


def _signer(idf):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = per_process(("Sampler",), Sampler)
        for part, data, offsets in slices(batches, "text"):
            owner, h, count = document_shingles(words(data, offsets))
            weight = weigh(h, count, idf.value)
            texts, samples = sampler.sample(owner, h, weight)
            total = np.bincount(owner, weight, part.num_rows)
            bands = np.zeros((len(texts), BANDS), np.uint64)
            for b in range(BANDS):
                for k in range(b * ROWS, (b + 1) * ROWS):
                    bands[:, b] = mix(bands[:, b] * np.uint64(31) + samples[:, k] + np.uint64(b + 1))
            ends = np.zeros(part.num_rows + 1, np.int64)
            ends[1:][texts] = BANDS
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(bands.ravel().view(np.int64)))
            ends[1:][texts] = samples.shape[1]
            drawn = pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(samples.ravel().astype(np.uint32).view(np.int32)))
            columns = {n: part.column(i) for i, n in enumerate(part.schema.names) if n != "text"}
            yield pa.RecordBatch.from_pydict(columns | {"total": pa.array(total), "bands": lists, "samples": drawn})

    return sign


def _vectors(idf):
    """Sorted hashes and weights of a text, as bytes; one weight if all are equal."""

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            owner, h, count = document_shingles(words(data, offsets))
            weight = weigh(h, count, idf.value)
            cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
            hs, ws = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = weight[a:b]
                hs.append(h[a:b].tobytes())
                ws.append((own[:1] if len(own) and (own == own[0]).all() else own).tobytes())
            columns = {n: part.column(i) for i, n in enumerate(part.schema.names) if n != "text"}
            yield pa.RecordBatch.from_pydict(columns | {"h": pa.array(hs, pa.binary()), "w": pa.array(ws, pa.binary())})

    return vector


def weighted_jaccard(ha: bytes, wa: bytes, hb: bytes, wb: bytes) -> float:
    x, y = np.frombuffer(ha, np.uint64), np.frombuffer(hb, np.uint64)
    u, v = np.frombuffer(wa, np.float64), np.frombuffer(wb, np.float64)
    u, v = (np.broadcast_to(w, n) if len(w) == 1 else w for w, n in ((u, len(x)), (v, len(y))))
    if not len(x) or not len(y):
        return 0.0
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = y[place] == x
    common = np.minimum(u[same], v[place[same]]).sum()
    return float(common / (u.sum() + v.sum() - common))


def _verify(least: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, *vectors = batch.columns
            good = [weighted_jaccard(*v) >= least for v in zip(*(c.to_pylist() for c in vectors), strict=True)]
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    return verify


def _across(least: float):
    """Links between the classes of two blocks of a bucket, as few as join them."""

    def compare(table: pa.Table) -> pa.Table:
        names, kind = np.unique(np.array(table["component"].to_pylist(), dtype=object), return_inverse=True)
        left, minor = (table[c].to_numpy() for c in ("left", "minor"))
        samples = table["samples"].combine_chunks().flatten().to_numpy().reshape(len(kind), -1)
        total = table["total"].to_numpy()
        hashes = [np.frombuffer(h, np.uint64) for h in table["h"].to_pylist()]
        sizes = np.array([len(h) for h in hashes])
        starts = np.cumsum(sizes) - sizes
        _, place = np.unique(np.concatenate(hashes), return_inverse=True)
        weight = np.concatenate([np.broadcast_to(np.frombuffer(w), n) for w, n in zip(table["w"].to_pylist(), sizes, strict=True)])
        class_of = np.arange(len(names))
        spread = np.zeros(place.max() + 1)
        links = []
        for x in np.flatnonzero(left):
            own = class_of[kind[x]]
            # of two rows outside the largest class, one asks the other
            rows = np.flatnonzero(~left & (class_of[kind] != own) & (~minor | (kind > kind[x])))
            rows = rows[_allowed(total[rows], total[x], least)]
            rows = rows[(samples[rows] == samples[x]).sum(1) >= samples.shape[1] // 2]
            if not len(rows):
                continue
            mine = slice(starts[x], starts[x] + sizes[x])
            spread[place[mine]] = weight[mine]
            spots = ragged(starts[rows], sizes[rows])
            common = np.minimum(weight[spots], spread[place[spots]])
            common = np.add.reduceat(common, np.cumsum(sizes[rows]) - sizes[rows])
            spread[place[mine]] = 0
            alike = common / (total[x] + total[rows] - common) >= least
            for other in np.unique(class_of[kind[rows[alike]]]):
                links.append((names[own], names[other]))
                class_of[class_of == other] = own
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return compare


def _allowed(t, u, least: float):
    return np.minimum(t, u) >= np.maximum(t, u) * (least - 1e-9)


def links_in_wide_buckets(rows: DataFrame, vectors: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between classes from all pairs of a bucket (one too wide for a join of pairs).

    Every pair of two classes has an end outside the bucket's largest class.  These rows are dealt to blocks, all
    rows to other blocks, and each pair of blocks meets in one task, which holds two blocks and returns
    fewer links than it has classes.  So a large class costs as many copies as there are blocks outside it.
    """
    of_class = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("t"))
    top = F.max_by(F.struct("component", "n", "t"), F.struct("n", "component"))
    sums = of_class.groupBy("bucket").agg(top.alias("top"), F.sum("n").alias("n"), F.sum("t").alias("t"))

    def blocks(n: Column, t: Column) -> Column:
        # a weight is at least 1, so a total is no less than the number of shingles, of 16 bytes
        return F.ceil(F.greatest(n / BLOCK_NODES, t * 16 / BLOCK_BYTES, F.lit(1))).cast("int")

    sums = sums.select(
        "bucket",
        F.col("top.component").alias("largest"),
        blocks(F.col("n") - F.col("top.n"), F.col("t") - F.col("top.t")).alias("outer"),
        blocks(F.col("n"), F.col("t")).alias("all"),
    )
    held = rows.join(sums, "bucket").withColumn("minor", F.col("component") != F.col("largest"))
    place = F.xxhash64("key", "bucket")
    asks = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda j: F.struct(F.pmod(place, F.col("outer")).cast("int").alias("i"), j.alias("j"), F.lit(True).alias("left")))
    asked = F.transform(F.sequence(F.lit(0), F.col("outer") - 1), lambda i: F.struct(i.alias("i"), F.pmod(place, F.col("all")).cast("int").alias("j"), F.lit(False).alias("left")))
    held = held.withColumn("spots", F.when(F.col("minor"), F.concat(asks, asked)).otherwise(asked))
    held = held.join(vectors, "key").select("bucket", "component", "minor", "total", "samples", "h", "w", F.inline("spots"))
    return held.groupBy("bucket", "i", "j").applyInArrow(_across(similarity), "a string, b string").distinct()


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    wide: int = WIDE,
) -> DataFrame:
    """All rows with ``class_id`` (least id of the class) and ``kept`` (one row of the class, of that id).

    Texts are linked if the weighted Jaccard similarity of their TF-IDF 5-word shingles (idf is
    damped, see ``damped``) is ``similarity`` or more; a class is what links connect.  Equal texts are one node.  Nodes that
    agree in a band of ``ROWS`` samples are compared: first each with one leader per bucket, and as members
    that joined one class need no more comparing, three rounds with other leaders close nearly
    every bucket, a large group of copies included.  In buckets that still hold several classes, all
    pairs across classes are compared, so no leader's choice loses a link: buckets of up to ``wide`` nodes by a
    join of pairs, others block by block, which sends no pair anywhere.  Only texts are paired whose
    total weights allow the similarity and that agree in half of the 36 samples, which a pair at the
    threshold misses 3 times in a million (and all bands 2 times in 10,000).

    Null texts of one id are a class, and alone in theirs without an id; a text without words is only like equal
    ones; one of fewer than five words has one shingle.  A null id counts as after all others.  Of the rows of a class's
    least id, or of all rows of a class without ids, the first by a hash of the whole row is kept; equal rows
    are told apart by their place in a stored copy.  Added columns take the place of others.
    """
    spark = docs.sparkSession
    rows = pack(docs, id=F.col(doc_id), text=F.col(text).cast("string"))
    texts = rows.select("text")
    idf = spark.sparkContext.broadcast(inverse_document_frequencies(texts))
    keyed = rows.where("text IS NOT NULL").select("id", F.md5("text").alias("key"), "text")
    id_type = keyed.schema["id"]
    signed = T.StructType([id_type, T.StructField("key", T.StringType()), T.StructField("total", T.DoubleType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("samples", T.ArrayType(T.IntegerType()))])
    signed = stash(keyed.mapInArrow(_signer(idf), signed), "near-signatures")
    nodes = signed.groupBy("key").agg(F.min("id").alias("least"), F.first("total").alias("total"), F.first("bands").alias("bands"), F.first("samples").alias("samples"))
    nodes = stash(nodes, "near-nodes")
    placed = nodes.select("key", "total", "samples", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("bucket")
    placed = stash(placed.join(shared, "bucket"), "near-buckets")
    wanted = placed.select("key").distinct().join(nodes.select("key", "least"), "key")
    chosen = keyed.withColumnRenamed("key", "_key").join(wanted, (F.col("_key") == F.col("key")) & F.col("id").eqNullSafe(F.col("least")))
    vectors = chosen.select("key", "text").mapInArrow(_vectors(idf), "key string, h binary, w binary")
    vectors = stash(vectors, "near-vectors").dropDuplicates(["key"])

    def alike() -> Column:
        """Total weights allow the similarity, and half of the samples agree."""
        ratio = F.least("ta", "tb") >= F.greatest("ta", "tb") * (similarity - 1e-9)
        agree = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
        return ratio & (agree >= BANDS * ROWS // 2)

    def linked(pairs: DataFrame) -> DataFrame:
        """Classes (a, b) of the pairs that are alike in full."""
        pairs = pairs.select("a", "b", F.col("component").alias("ca"), "cb").distinct()
        one = vectors.select(F.col("key").alias("a"), F.col("h").alias("ha"), F.col("w").alias("wa"))
        two = vectors.select(F.col("key").alias("b"), F.col("h").alias("hb"), F.col("w").alias("wb"))
        both = pairs.join(one, "a").join(two, "b")
        both = both.select(F.col("ca").alias("a"), F.col("cb").alias("b"), "ha", "wa", "hb", "wb")
        return both.mapInArrow(_verify(similarity), "a string, b string").distinct()

    open_ = placed.withColumn("component", F.col("key"))
    of = None
    for turn in range(LEADER_ROUNDS + 1):
        if open_.isEmpty():
            break
        if turn < LEADER_ROUNDS:
            # leaders by a hash of the node, so that buckets of one group mostly share theirs
            first = F.min_by(F.struct(F.col("key").alias("b"), F.col("total").alias("tb"), F.col("samples").alias("sb"), F.col("component").alias("cb")), F.xxhash64("key", F.lit(turn)))
            leaders = open_.groupBy("bucket").agg(first.alias("_l")).select("bucket", "_l.*")
            pairs = open_.withColumnsRenamed({"key": "a", "total": "ta", "samples": "sa"}).join(leaders, "bucket").where((F.col("component") != F.col("cb")) & alike())
        else:
            many = open_.groupBy("bucket").agg((F.count(F.lit(1)) > wide).alias("wide"))
            sized = stash(open_.join(many, "bucket"), "near-sized")
            in_wide = links_in_wide_buckets(sized.where("wide"), vectors, similarity)
            open_ = sized.where("NOT wide")
            other = open_.select("bucket", F.col("key").alias("b"), F.col("total").alias("tb"), F.col("samples").alias("sb"), F.col("component").alias("cb"))
            pairs = open_.withColumnsRenamed({"key": "a", "total": "ta", "samples": "sa"}).join(other, "bucket").where((F.col("component") < F.col("cb")) & alike())
        found = linked(pairs)
        found = stash(found if turn < LEADER_ROUNDS else found.unionByName(in_wide), "near-links")
        if found.isEmpty():
            continue
        of = stash(merged(of, found), "near-classes")
        open_ = placed.join(of.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
        mixed = open_.groupBy("bucket").agg((F.min("component") < F.max("component")).alias("mixed")).where("mixed")
        open_ = stash(open_.join(mixed.select("bucket"), "bucket"), "near-open")
    if of is not None:
        nodes = nodes.join(of.withColumnRenamed("node", "key"), "key", "left")
    else:
        nodes = nodes.withColumn("component", F.lit(None).cast("string"))
    nodes = nodes.withColumn("component", F.coalesce("component", "key"))
    least = nodes.groupBy("component").agg(F.min("least").alias("class_id"))
    classes = stash(nodes.join(least, "component").select("key", "class_id", "component"), "near-classes")
    # classes with several rows of the least id: in most tables there are none
    first = signed.select("key", "id").join(classes, "key").where(F.col("id").eqNullSafe(F.col("class_id")))
    first = first.groupBy("component").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    blank = rows.where("text IS NULL AND id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    first, blank = stash(first.select("component"), "near-repeated"), stash(blank.select("id"), "near-repeated")
    rows = rows.withColumn("key", F.md5("text"))
    several, blanks = not first.isEmpty(), not blank.isEmpty()
    tied = None
    if several:
        held = classes.join(first, "component").withColumn("repeated", F.lit(True))
        classes = classes.join(held.select("key", "repeated"), "key", "left")
        tied = rows.join(held.drop("repeated"), "key").where(F.col("id").eqNullSafe(F.col("class_id"))).select("_row", "component", "class_id")
    else:
        classes = classes.withColumn("repeated", F.lit(None).cast("boolean"))
    if blanks:
        more = rows.where("text IS NULL").join(blank, "id")
        more = more.select("_row", F.concat(F.lit("id "), F.col("id").cast("string")).alias("component"), F.col("id").alias("class_id"))
        tied = more if tied is None else tied.unionByName(more)
    rows = rows.join(classes, "key", "left")
    if blanks:
        rows = rows.join(blank.select(F.col("id").alias("_id"), F.lit(True).alias("_blank")), F.col("text").isNull() & (F.col("id") == F.col("_id")), "left")
        rows = rows.withColumn("repeated", F.coalesce("repeated", "_blank"))
    alone = F.col("text").isNull()
    rows = rows.withColumn("class_id", F.when(alone, F.col("id")).otherwise(F.col("class_id")))
    own = F.col("id").eqNullSafe(F.col("class_id"))
    if tied is None:
        return unpack(rows.withColumn("kept", own), ["class_id", "kept"])
    rest = rows.where(~(own & F.coalesce("repeated", F.lit(False)))).select("_row", "class_id", own.alias("kept"))
    place = F.struct(F.md5(F.to_json("_row")).alias("row"), F.monotonically_increasing_id().alias("place"))
    tied = stash(tied.withColumn("_place", place), "near-tied")
    chosen = tied.groupBy("component").agg(F.min("_place").alias("_chosen"))
    tied = tied.join(chosen, "component").select("_row", "class_id", (F.col("_place") == F.col("_chosen")).alias("kept"))
    return unpack(rest.unionByName(tied), ["class_id", "kept"])
