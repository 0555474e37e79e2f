"""Date helpers and the date spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STEP = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH"}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_date(raw: Column | str) -> Column:
    """DATE from an ISO string or from month/day/year; anything else raises under ANSI."""
    text = _col(raw).cast("string")
    slashed = text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$")
    return F.when(slashed, F.to_date(text, "M/d/yyyy")).otherwise(text.cast("date"))


def subtract_days(date: Column | str, days: int) -> Column:
    return F.date_sub(_col(date), days)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start)).cast("bigint")


def month_start(date: Column | str) -> Column:
    return F.trunc(_col(date), "MM")


def week_start(date: Column | str) -> Column:
    """Monday of the date's week."""
    return F.trunc(_col(date), "WEEK")


def recent_months(df: DataFrame, date: str, as_of: dt.date | str, months: int = 6) -> DataFrame:
    """Rows dated on or after the first day of the month ``months`` before ``as_of``."""
    floor = F.trunc(F.add_months(F.lit(str(as_of)).cast("date"), -months), "MM")
    return df.where(F.col(date) >= floor)


def date_bounds(df: DataFrame, date: str) -> DataFrame:
    """One row: first and last date."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def spine_over(bounds: DataFrame, first: str, end: str, part: str = "day") -> DataFrame:
    """Explode each row's [first, end) into one row per step, in a column ``date_day``.

    Other columns of ``bounds`` are kept, so a row per series gives a spine per series.
    A row whose range is empty or NULL gives no rows.
    """
    step = F.expr(_STEP[part])
    days = F.when(
        F.col(first) < F.col(end), F.sequence(F.col(first), F.date_sub(F.col(end), 1), step)
    )
    return bounds.select(
        *[c for c in bounds.columns if c not in (first, end)], F.explode(days).alias("date_day")
    )


def date_spine(
    spark: SparkSession, start: dt.date | str, end: dt.date | str, part: str = "day"
) -> DataFrame:
    """Every step from ``start`` (included) to ``end`` (excluded)."""
    one = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("_first"), F.lit(str(end)).cast("date").alias("_end")
    )
    return spine_over(one, "_first", "_end", part)
