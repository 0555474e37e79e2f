"""Type-2 history: one row per key and period during which the tracked columns held."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _differs(columns: Sequence[str], old: str, new: str) -> Column:
    same = [F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in columns]
    return ~reduce(lambda a, b: a & b, same)


def scd2_start(snapshot: DataFrame, as_of: dt.date | str) -> DataFrame:
    """A first history: every snapshot row is current since ``as_of``."""
    return snapshot.withColumns(
        {
            "valid_from": F.lit(str(as_of)).cast("date"),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: dt.date | str,
    close_missing: bool = False,
) -> DataFrame:
    """Bring a history up to date with a new snapshot of the same columns.

    A changed key closes its current row at ``as_of`` and opens a new one; a new key opens
    one; a key missing from the snapshot stays current unless ``close_missing``.  Current
    rows meet the snapshot in one full outer join, each pair giving one or two rows; closed
    rows pass by the join.  ``history`` is read twice and should be a stored table.
    """
    columns = snapshot.columns
    day = F.lit(str(as_of)).cast("date")
    period = ["valid_from", "valid_to", "is_current"]
    old = history.where("is_current").select(
        F.col(key).alias("_key"), F.struct(*columns, *period).alias("old")
    )
    new = snapshot.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    pair = old.join(new, "_key", "full_outer")

    gone = F.col("new").isNull()
    changed = F.col("old").isNotNull() & ~gone & _differs(tracked, "old", "new")
    closes = changed | (gone if close_missing else F.lit(False))
    kept = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in columns],
        F.col("old.valid_from").alias("valid_from"),
        F.when(closes, day).otherwise(F.col("old.valid_to")).alias("valid_to"),
        (~closes).alias("is_current"),
    )
    opened = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in columns],
        day.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), kept),
            F.when(F.col("old").isNull() | changed, opened),
        )
    )
    fresh = pair.select(F.explode(rows).alias("row")).select("row.*")
    closed = history.where(~F.col("is_current")).select(*columns, *period)
    return closed.unionByName(fresh)


def scd2_from_snapshots(
    snapshots: DataFrame, key: str, tracked: Sequence[str], date: str
) -> DataFrame:
    """History from dated snapshots, one row per key and date.

    A row starts a period when a tracked column differs from the key's previous snapshot.
    """
    by_date = W.partitionBy(key).orderBy(date)
    before = snapshots.withColumns(
        {
            "new": F.struct(*tracked),
            "old": F.lag(F.struct(*tracked)).over(by_date),
        }
    )
    starts = before.where(F.col("old").isNull() | _differs(tracked, "old", "new"))
    upto = F.lead(date).over(by_date)
    return starts.select(
        key, *tracked, F.col(date).alias("valid_from"), upto.alias("valid_to")
    ).withColumn("is_current", F.col("valid_to").isNull())
