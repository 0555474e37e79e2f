"""Views and stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash

CELL_BITS = 6  # ranges of a clustered column: 64


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL under ``name`` without storing it."""
    df.createOrReplaceTempView(name)
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def footer_bounds(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row: least and largest value of a stored date or number, from the files' footers.

    Spark answers the aggregate from Parquet statistics in its newer reader, which a session of
    its own turns on, so that the caller's settings stay.  No rows are read.  (Texts and
    timestamps have no usable statistics; they are read.)
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.min(column).alias("least"), F.max(column).alias("most"))


def _number(df: DataFrame, column: str) -> Column:
    """A column as a number of the same order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    raise ValueError(f"cannot cluster by {column} of type {kind.simpleString()}")


def _bounds_below(bounds: Sequence[float], value: Column) -> Column:
    """How many of the bounds are less than the value; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    below = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda bound: bound < value)
    return F.when(value.isNull(), 0).otherwise(F.size(below))


def morton_cell(df: DataFrame, columns: Sequence[str], bits: int = CELL_BITS) -> Column:
    """Cell of a grid over ``columns``, numbered along a Morton curve.

    Each column is cut in ``2**bits`` ranges of about as many rows (bounds from one sketch over the
    rows; NULL is in the first range), and the bits of the range numbers are interleaved.  Rows that are near
    in the order of cells are near in every column, so sorted files have narrow bounds for each.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    asked = [F.percentile_approx(_number(df, c), shares).alias(f"_{i}") for i, c in enumerate(columns)]
    found = df.agg(*asked).first()
    cell = F.lit(0).cast("long")
    for i, column in enumerate(columns):
        bounds = sorted(set(found[f"_{i}"] or []))
        value = _number(df, column)
        # a column of few values uses the high bits as well as one of many
        place = F.floor(_bounds_below(bounds, value) * (2**bits / (len(bounds) + 1))).cast("long")
        for b in range(bits):
            one = F.shiftright(place, b).bitwiseAND(F.lit(1).cast("long"))
            cell = cell.bitwiseOR(F.shiftleft(one, b * len(columns) + i))
    return cell


def laid_out(
    df: DataFrame,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Rows arranged for writing: partition columns first, then ``sort_by``.

    ``cluster_by`` names columns that are filtered on alone or together: rows are then ordered by
    their Morton cell before ``sort_by``.  The frame is read once more for it.

    With partition columns the rows are rebalanced on them: AQE splits a partition that is
    too large for one task and merges small ones, without a sampling pass.  Without them
    the rows are range-partitioned on ``sort_by``, so each file covers a narrow range.
    """
    names = df.columns
    rest = [c for c in sort_by if c not in partition_by]
    if cluster_by:
        df = df.withColumn("_cell", morton_cell(df, cluster_by))
        rest = ["_cell", *rest]
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    elif rest:
        df = df.repartitionByRange(*rest)
    layout = [*partition_by, *rest]
    return df.sortWithinPartitions(*layout).select(*names) if layout else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] | None = None,
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Store a full rebuild as parquet and return the stored table.

    ``cluster_by`` gives narrow ranges for several columns at once, at the cost of storing the
    frame before it is laid out.

    Rows are sorted by ``sort_by`` within files, so row groups carry narrow min/max ranges
    and scans can skip them.  End ``sort_by`` with a key: without partition columns, rows
    that agree on all of its columns stay in one task.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if cluster_by:
        df = stash(df, "to-cluster")
    writer = laid_out(df, parts, sort_by, cluster_by).write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    return read_table(df.sparkSession, path)
