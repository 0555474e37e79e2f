"""Daily and weekly revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    date_bounds,
    date_spine,
    mean_of,
    spine_over,
    surrogate_key,
    week_start,
)
from ..operators.series import days_since_start, densify_days, rolling_avg, rolling_sum
from ..session import stash

DIMS = ["customer_segment", "loyalty_tier", "primary_product_category"]
_COUNTS = ["order_count", "unique_customers", "total_units_sold"]
_AMOUNTS = ["total_revenue", "total_gross_sales", "total_refunds"]


def daily_revenue(facts: DataFrame) -> DataFrame:
    """Completed orders by day, segment, tier and main category.

    order_id is the key of the facts, so orders are counted plainly; customers need the one
    distinct count, which Spark spreads by (group, customer) before it counts.
    """
    return (
        facts.where("is_completed")
        .groupBy("order_date", *DIMS)
        .agg(
            F.count("order_id").alias("order_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.sum("net_sales").alias("total_revenue"),
            F.sum("gross_item_sales").alias("total_gross_sales"),
            F.sum("total_refund_amount").alias("total_refunds"),
            mean_of("net_sales").alias("avg_order_value"),
            F.sum("total_item_quantity").alias("total_units_sold"),
        )
    )


def _spine(daily: DataFrame, start, end) -> DataFrame:
    if start is not None and end is not None:
        return date_spine(daily.sparkSession, start, end)
    seen = date_bounds(daily, "order_date")
    first = F.lit(str(start)).cast("date") if start is not None else F.col("min_date")
    after = F.lit(str(end)).cast("date") if end is not None else F.date_add("max_date", 1)
    return spine_over(seen.select(first.alias("_first"), after.alias("_end")), "_first", "_end")


def _dense_spine(daily: DataFrame, spine: DataFrame) -> DataFrame:
    """Every day for every series: each series row explodes into its days."""
    bounds = spine.agg(
        F.min("date_day").alias("_first"), F.date_add(F.max("date_day"), 1).alias("_end")
    )
    series = daily.select(*DIMS).distinct()
    first, end = (bounds.select(c).scalar() for c in ("_first", "_end"))
    return spine_over(series.withColumns({"_first": first, "_end": end}), "_first", "_end")


def daily_on_spine(
    daily: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    dense: bool = False,
) -> DataFrame:
    """Daily revenue with the missing days filled in.

    ``start`` is included and ``end`` excluded; both default to the range of the data.
    By default a day without orders gives one row without dimensions.  ``dense`` instead
    gives every series a row for every day, so that rolling rows are rolling days.
    ``daily`` is read up to four times: pass a stored frame, not one still to be computed.
    """
    spine = _spine(daily, start, end)
    if dense:
        key = F.struct("order_date", *DIMS)
        facts = daily.select(key.alias("_key"), *_COUNTS, *_AMOUNTS, "avg_order_value")
        days = _dense_spine(daily, spine)
        days = days.withColumn("_key", F.struct(F.col("date_day").alias("order_date"), *DIMS))
        joined = days.join(facts, "_key", "left").drop("_key")
    else:
        joined = densify_days(spine, daily, "order_date")
    zero = F.lit(0)
    return joined.select(
        F.col("date_day").alias("revenue_date"),
        *DIMS,
        surrogate_key("date_day", *DIMS).alias("daily_revenue_key"),
        *[F.coalesce(c, zero).alias(c) for c in _COUNTS],
        *[F.coalesce(c, zero.cast("decimal(38,6)")).alias(c) for c in _AMOUNTS],
        "avg_order_value",
    )


def daily_revenue_summary(
    facts: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    dense: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Daily revenue per series with 7-row mean, 30-row total and days since the start.

    The facts are aggregated once and stored; everything after that works on daily rows.
    A series has at most one row per day, so the windows are as long as the calendar.
    """
    per_day = stash(daily_revenue(facts), "daily-revenue")
    daily = daily_on_spine(per_day, start, end, dense)
    out = rolling_avg(daily, DIMS, ["revenue_date"], "total_revenue", "revenue_7day_avg", 7)
    out = rolling_sum(out, DIMS, ["revenue_date"], "total_revenue", "revenue_30day_total", 30)
    out = days_since_start(
        out, ["customer_segment", "loyalty_tier"], "revenue_date", "days_since_segment_start"
    )
    if ordered:
        out = out.orderBy(
            F.desc("revenue_date"),
            F.asc_nulls_last("customer_segment"),
            F.asc_nulls_last("loyalty_tier"),
            F.desc("total_revenue"),
        )
    return out


def weekly_revenue(daily: DataFrame) -> DataFrame:
    """Daily rows (with ``revenue_date``) summed to weeks that start on Monday."""
    return daily.groupBy(week_start("revenue_date").alias("week_start_date"), *DIMS).agg(
        F.sum("order_count").alias("order_count"),
        F.sum("total_units_sold").alias("total_units_sold"),
        *[F.sum(c).alias(c) for c in _AMOUNTS],
    )
