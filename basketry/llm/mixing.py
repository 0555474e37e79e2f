"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stash
from .rows import pack, unpack

ROWS_PER_BUCKET = 2_000


def word_count(text: Column) -> Column:
    """Runs of characters other than space and tab to carriage return; null has none."""
    runs = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(runs, F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the md5 of the key, the same in every run and engine."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (number + 1) / F.lit(float(2**52 + 1))


def source_targets(
    totals: DataFrame,
    source: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
) -> DataFrame:
    """Add ``target`` to a table with one row per source and its ``source_size``.

    Sources in code-point order, null last, take the weights in turn.  They share ``share`` of
    all sizes by weight; no target exceeds ``epochs`` times its source's size, and what is over
    goes to the others by weight.  Filled in order of the level at which a source is full, that
    is one running sum: a source is full if the level that is left for it and those after it
    reaches its own.  The table has a row per source, so plain windows over all of it will do.
    """
    in_order = W.orderBy(F.col(source).asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    full_at = W.orderBy("_full", F.col(source).asc_nulls_last())
    before, after = (W.unboundedPreceding, -1), (0, W.unboundedFollowing)
    everything = W.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(
        F.sum("_cap").over(full_at.rowsBetween(*before)), F.lit(0.0)
    )
    level = left / F.sum("_weight").over(full_at.rowsBetween(*after))
    return (
        totals.withColumn("_turn", turn)
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("_turn") + 1))
        .withColumn("_cap", F.lit(float(epochs)) * F.col("source_size"))
        .withColumn("_full", F.col("_cap") / F.col("_weight"))
        .withColumn("_level", level)
        .withColumn("_level", F.max(F.when(F.col("_level") < F.col("_full"), F.col("_level"))).over(everything))
        .withColumn("target", F.least("_cap", F.col("_level") * F.col("_weight")))
        .drop("_turn", "_weight", "_cap", "_full", "_level")
    )


def mix_sources(
    docs: DataFrame,
    size: Column,
    *,
    source: str = "source",
    doc_id: str = "doc_id",
    quality: Column | None = None,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    A source whose target is e times its size and a rest gives e whole copies of every document,
    and the rest is drawn without replacement: documents are ordered by -ln(u) / quality with u
    from the hash of the id, and taken while that brings the running size nearer to the rest.

    Only one bucket of keys per source needs an order.  The key is mapped to buckets by the
    distribution it would have if all qualities were the mean one, so a bucket has at most
    (largest quality / mean quality) times 2,000 documents or so, however large the source.
    Sizes per bucket then tell which buckets are taken whole and which one holds the edge.

    Null sources form one source; null quality counts as 1 and a quality of zero or less as
    1e-6; null sizes count as 0; documents without words are taken with their source's whole
    copies only.  Ties in key and id go by size; repeated rows are documents of their own.  Added
    columns take the place of columns of the same name.  An empty table stays empty.
    """
    spark = docs.sparkSession
    good = F.coalesce(quality, F.lit(1.0)) if quality is not None else F.lit(1.0)
    rows = pack(
        docs,
        _source=F.col(source),
        _id=F.col(doc_id),
        size=F.coalesce(size, F.lit(0)).cast("long"),
        _quality=F.greatest(good.cast("double"), F.lit(1e-6)),
        _u=uniform(F.col(doc_id), seed),
    ).withColumn("_key", -F.log("_u") / F.col("_quality"))
    small = stash(rows.select("_source", "size", "_quality", "_key"), "mix-keys")
    per_source = small.groupBy("_source").agg(
        F.sum("size").alias("source_size"),
        F.count(F.lit(1)).alias("_rows"),
        F.avg("_quality").alias("_mean_quality"),
    )
    targets = source_targets(per_source, "_source", weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("_whole", whole.cast("long")).withColumns(
        {
            "_rest": F.col("target") - F.col("_whole") * F.col("source_size"),
            "_buckets": F.ceil(F.col("_rows") / ROWS_PER_BUCKET),
        }
    )
    targets = stash(targets, "mix-targets")  # its size is known then, so Spark decides on a broadcast
    bucket = F.floor((1 - F.exp(-F.col("_key") * F.col("_mean_quality"))) * F.col("_buckets"))
    bucket = F.least(bucket, F.col("_buckets") - 1)

    def with_bucket(df: DataFrame) -> DataFrame:
        t = targets.withColumnRenamed("_source", "_of")
        joined = df.join(t, F.col("_source").eqNullSafe(F.col("_of")))
        return joined.withColumn("_bucket", bucket).drop("_of")

    order = W.partitionBy("_source").orderBy("_bucket")
    filled = (
        with_bucket(small)
        .groupBy("_source", "_bucket", "_rest")
        .agg(F.sum("size").alias("_size"))
        .withColumn("_upto", F.sum("_size").over(order))
        .where(F.col("_upto") >= F.col("_rest"))
        .groupBy("_source")
        .agg(F.min(F.struct("_bucket", (F.col("_upto") - F.col("_size")).alias("_before"))).alias("_e"))
        .select(F.col("_source").alias("_of"), F.col("_e._bucket").alias("_edge"), F.col("_e._before").alias("_before"))
    )
    filled = stash(filled, "mix-edges")
    rows = with_bucket(rows)
    rows = rows.join(filled, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
    at_edge = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    sure = rows.where(~at_edge).withColumn(
        "_extra", F.coalesce((F.col("_bucket") < F.col("_edge")) & (F.col("_rest") > 0), F.lit(False)).cast("long")
    )
    upto = F.sum("size").over(
        W.partitionBy("_source").orderBy("_key", "_id", "size").rowsBetween(W.unboundedPreceding, 0)
    )
    edge = rows.where(at_edge).withColumn("_upto", F.col("_before") + upto)
    nearer = 2 * (F.col("_rest") - F.col("_upto")) + F.col("size") >= 0
    edge = edge.withColumn("_extra", (nearer & (F.col("_rest") > 0)).cast("long")).drop("_upto")
    out = sure.unionByName(edge).withColumn("copies", F.col("_whole") + F.col("_extra"))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return unpack(out, ["size", "source_size", "target", "copies", "taken"])
