"""Sharding by extendible hashing on the bits of a hash (DataFrame only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stash
from .rows import pack, unpack

HASH_BITS = 60
SLACK_BITS = 4  # a directory has about 2**SLACK_BITS entries per shard
ROUND_BITS = 20  # so many bits are added at once at most
SHARD_BYTES = 64 << 20


def hash_bits(key: Column) -> Column:
    """60 bits of the md5 of the key as text; null hashes as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(bits: int) -> Column:
    return F.shiftright("_hash", HASH_BITS - bits)


def _split(rows: DataFrame, start: int, end: int, limit: int) -> DataFrame:
    """Directory entries on ``end`` bits: their shard's depth, or null if still too large.

    A node of the binary tree over the hash is a shard if it fits or holds one document, and its
    parent does neither.  Sizes of all nodes come from the entries, so the rows are read once.
    """
    entries = rows.groupBy(_prefix(end).alias("_entry")).agg(
        F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    at = entries.withColumn("_depth", F.explode(F.sequence(F.lit(start), F.lit(end))))
    at = at.withColumn("_node", F.expr(f"shiftright(_entry, {end} - _depth)"))
    fits = (F.sum("_bytes") <= limit) | (F.sum("_rows") == 1)
    nodes = at.groupBy("_depth", "_node").agg(fits.alias("_fits"))
    first = at.join(nodes, ["_depth", "_node"]).where("_fits").groupBy("_entry").agg(F.min("_depth").alias("_depth"))
    return entries.select("_entry").join(first, "_entry", "left")


def shard(
    docs: DataFrame,
    size: Column,
    *,
    doc_id: str = "doc_id",
    limit: int = SHARD_BYTES,
) -> DataFrame:
    """All rows with ``shard`` (the hash-prefix bits as text) and ``shard_depth``.

    One bucket holds everything at first; a bucket over ``limit`` bytes splits on the next bit
    of the hash of the id, the others stay.  The directory maps a hash prefix of the depth of
    the deepest bucket to its bucket.  It is found from sizes per entry, on as many bits as the
    total size asks for, and only entries that are still too large go on to more bits.

    A document over the limit gets a shard of its own.  Rows with the same hash (repeated ids,
    null ids) that exceed it together are cut into runs, named prefix-run, by a running
    sum over the partitions in which they come in: totals of these first, so no task holds them all.  Null sizes count as 0.  The
    added columns take the place of columns of the same name; an empty table stays empty.
    """
    bytes_of = F.coalesce(size, F.lit(0)).cast("long")
    # the partition in which a row comes in: joins by hash below would bring all rows of one hash together
    rows = pack(docs, _hash=hash_bits(F.col(doc_id)), _bytes=bytes_of).withColumn("_chunk", F.spark_partition_id())
    pending = stash(rows.select("_hash", "_bytes"), "shard-sizes")
    total = pending.agg(F.sum("_bytes")).first()[0] or 0
    start, end = 0, min(ROUND_BITS, max(1, math.ceil(math.log2(max(total / limit, 1))) + SLACK_BITS))
    rows = rows.withColumn("_depth", F.lit(None).cast("int"))
    while True:
        directory = stash(_split(pending, start, end, limit), "shard-directory")
        found = directory.where("_depth IS NOT NULL").withColumnRenamed("_depth", "_found")
        rows = (
            rows.join(found, _prefix(end) == F.col("_entry"), "left")
            .withColumn("_depth", F.coalesce("_depth", "_found"))
            .drop("_entry", "_found")
        )
        over = directory.where("_depth IS NULL").select("_entry")
        if over.isEmpty():
            tied = None
            break
        pending = pending.join(over, _prefix(end) == F.col("_entry"), "left_semi")
        if end == HASH_BITS:
            tied = over
            break
        pending = stash(pending, "shard-sizes")
        start, end = end + 1, min(HASH_BITS, end + ROUND_BITS)
    bits = F.lpad(F.bin("_hash"), HASH_BITS, "0")
    name = F.substring(bits, F.lit(1), F.coalesce("_depth", F.lit(HASH_BITS)))
    rows = rows.withColumns({"shard": name, "shard_depth": F.coalesce("_depth", F.lit(HASH_BITS))})
    if tied is not None:
        rows = rows.where("_depth IS NOT NULL").drop("_chunk").unionByName(_runs(rows.where("_depth IS NULL"), limit))
    return unpack(rows, ["shard", "shard_depth"])


def _runs(rows: DataFrame, limit: int) -> DataFrame:
    """Cut rows of equal hash into runs of at most ``limit`` bytes each, or one row.

    A run takes half the limit by running sum, so that the row on its edge fits as well; rows
    of over half the limit are runs alone.
    """
    rows = stash(rows, "shard-ties")
    large = F.col("_bytes") * 2 > limit
    rows = rows.withColumn("_step", F.when(large, F.lit(0)).otherwise(F.col("_bytes")))
    rows = rows.withColumn("_large", large.cast("long"))
    in_chunk = W.partitionBy("_hash", "_chunk").orderBy("_bytes")
    upto = in_chunk.rowsBetween(W.unboundedPreceding, 0)
    chunks = rows.groupBy("_hash", "_chunk").agg(F.sum("_step").alias("_s"), F.sum("_large").alias("_l"))
    before = W.partitionBy("_hash").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = chunks.select(
        "_hash", "_chunk", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s"), F.coalesce(F.sum("_l").over(before), F.lit(0)).alias("_l")
    )
    rows = rows.join(chunks, ["_hash", "_chunk"])
    run = F.floor((F.col("_s") + F.sum("_step").over(upto) - F.col("_step")) * 2 / limit)
    alone = F.concat(F.lit("-x"), F.col("_l") + F.sum("_large").over(upto))
    label = F.when(F.col("_large") == 1, alone).otherwise(F.concat(F.lit("-"), run))
    rows = rows.withColumn("_label", label).withColumn("shard", F.concat("shard", "_label"))
    return rows.drop("_chunk", "_step", "_large", "_s", "_l", "_label")
