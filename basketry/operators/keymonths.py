"""A stored map from keys to the months their rows may be in, so that a merge reads few months."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_folder

NAME = "_months_of_keys"  # Spark's readers pass over names that begin with an underscore
RANGES = 32


def in_months(month: str, values: set) -> Column:
    known = F.col(month).isin([v for v in values if v is not None])
    return known | F.col(month).isNull() if None in values else known


def key_ranges(keys: DataFrame, key: str, ranges: int = RANGES) -> list[tuple] | None:
    """At most ``ranges`` intervals that hold all keys; None if there is no key but NULL.

    The span of the keys is cut into equal parts, and neighbouring parts with keys are joined:
    an old key beside many new ones gets an interval of its own.  Keys that are no whole
    numbers get one interval.
    """
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if low is None:
        return None
    if not isinstance(keys.schema[key].dataType, T.IntegralType):
        return [(low, high)]
    width = (high - low) // ranges + 1
    part = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("int")
    found = keys.where(F.col(key).isNotNull()).groupBy(part.alias("part"))
    joined: list[list] = []
    for number, first, last in sorted(found.agg(F.min(key), F.max(key)).collect()):  # ``ranges`` rows
        if joined and joined[-1][0] == number - 1:
            joined[-1][0], joined[-1][2] = number, last
        else:
            joined.append([number, first, last])
    return [(first, last) for _, first, last in joined]


def within_key_ranges(df: DataFrame, keys: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """Rows whose key lies in one of the few intervals that hold the keys of ``keys``.

    Drops only rows that cannot match.  The bounds are literals, so the scan skips the files and row groups
    outside them, and one old key does not make it read all that lies between.
    """
    spans = key_ranges(keys, key, ranges)
    nulls = keys.where(F.col(key).isNull()).limit(1).count() > 0
    inside = F.col(key).isNull() if nulls else F.lit(False)
    for first, last in spans or []:
        inside = inside | F.col(key).between(first, last)
    return df.where(inside) if spans or nulls else df.limit(0)


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root}/{NAME}")
    except AnalysisException as error:
        if error.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise


def _write(rows: DataFrame, root: str, key: str, mode: str) -> None:
    # sorted by key, so that the few row groups around a key are found by their bounds
    laid = rows.distinct().repartitionByRange(key, "month").sortWithinPartitions(key)
    laid.write.mode(mode).parquet(f"{root}/{NAME}")


def forget_months(spark: SparkSession, root: str) -> None:
    remove_folder(spark, f"{root}/{NAME}")


def record_months(updates: DataFrame, target: DataFrame | None, root: str, key: str, month: str) -> None:
    """Add the keys of ``updates`` with their months; call it before the table itself changes.

    The map may name a month too many (a row moved on, a merge that failed), but never one too
    few: where there is no map yet, it is made from the whole target.
    """
    spark = updates.sparkSession
    new = updates.select(key, F.col(month).alias("month"))
    stored = _stored(spark, root)
    if stored is None:
        if target is not None:
            new = new.unionByName(target.select(key, F.col(month).cast("date").alias("month")))
        _write(new, root, key, "overwrite")
        return
    near = within_key_ranges(stored, updates, key).toDF("_key", "_month")
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("month").eqNullSafe(F.col("_month"))
    _write(new.join(near, same, "left_anti"), root, key, "append")


def months_of_keys(spark: SparkSession, root: str, keys: DataFrame, key: str) -> set | None:
    """Months that may hold rows of the keys, or None where no map is stored."""
    stored = _stored(spark, root)
    if stored is None:
        return None
    named = keys.select(F.col(key).alias("_key")).distinct()
    near = within_key_ranges(stored, keys, key)
    hit = near.join(named, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return {r[0] for r in hit.select("month").distinct().collect()}  # no more than the table has months
