"""Windows over aggregated series: rolling rows, running totals, previous row, series start.

These expect one row per series and step (a day or month), so a partition is as long as
the calendar, not as long as the data.  For groups without such a bound use
``operators.ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import days_between


def _last_rows(parts: Sequence[str], order: Sequence[Column | str], rows: int):
    return W.partitionBy(*parts).orderBy(*order).rowsBetween(-(rows - 1), W.currentRow)


def rolling_avg(
    df: DataFrame, parts: Sequence[str], order: Sequence[Column | str], col: str, name: str,
    rows: int = 7,
) -> DataFrame:
    """Mean over the current and the ``rows - 1`` preceding rows (rows, not days)."""
    w = _last_rows(parts, order, rows)
    total, n = F.sum(col).over(w).cast("double"), F.count(col).over(w).cast("double")
    return df.withColumn(name, F.try_divide(total, n))


def rolling_sum(
    df: DataFrame, parts: Sequence[str], order: Sequence[Column | str], col: str, name: str,
    rows: int = 30,
) -> DataFrame:
    return df.withColumn(name, F.sum(col).over(_last_rows(parts, order, rows)))


def running_total(
    df: DataFrame, parts: Sequence[str], order: Sequence[Column | str], col: str, name: str
) -> DataFrame:
    w = W.partitionBy(*parts).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(name, F.sum(col).over(w))


def lag_value(
    df: DataFrame, parts: Sequence[str], order: Sequence[Column | str], col: str, name: str
) -> DataFrame:
    """Value of the previous row of the series."""
    return df.withColumn(name, F.lag(col).over(W.partitionBy(*parts).orderBy(*order)))


def days_since_start(df: DataFrame, parts: Sequence[str], date: str, name: str) -> DataFrame:
    """Days since the first date of the series the row belongs to.

    The first dates are aggregated and joined back; the struct key matches NULLs too.  The
    frame is read twice, so store it first if it is costly.
    """
    key = F.struct(*parts)
    starts = df.groupBy(key.alias("_series")).agg(F.min(date).alias("_start"))
    return (
        df.withColumn("_series", key)
        .join(starts, "_series")
        .withColumn(name, days_between("_start", date))
        .drop("_series", "_start")
    )


def densify_days(spine: DataFrame, facts: DataFrame, day: str) -> DataFrame:
    """All spine days, each with the facts of that day (one NULL row if there are none)."""
    return spine.join(facts, spine["date_day"] == facts[day], "left").drop(day)
