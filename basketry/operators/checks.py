"""Data-quality checks.  Each returns the violating rows; an empty result is a pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import days_between
from ..sources.tables import footer_bounds
from .ordered import exact_percentiles

TOLERANCE = 0.01


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    return check_unique_combination(df.where(F.col(col).isNotNull()), [col])


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once; NULLs compare as equal."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row."""
    known = parent.select(F.col(parent_col).alias(col))
    return child.where(F.col(col).isNotNull()).join(known, col, "left_anti")


def check_accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts.  NULL passes."""
    return (
        df.where(~F.col(col).isin(list(values)))
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def out_of_range(
    col: str, min_value=None, max_value=None, inclusive: bool = True
) -> Column:
    """Condition that holds for a value below the minimum or above the maximum."""
    c, bad = F.col(col), F.lit(False)
    if min_value is not None:
        bad = bad | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        bad = bad | ((c > max_value) if inclusive else (c >= max_value))
    return bad


def check_range(
    df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Rows outside the range.  NULL passes, and so does everything without a bound."""
    return df.where(out_of_range(col, min_value, max_value, inclusive))


def check_expression(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows for which the expression is false.  NULL passes."""
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~condition)


def check_at_least_one(df: DataFrame, col: str) -> DataFrame:
    """One row if the column has no value at all."""
    return df.agg(F.count(col).alias("n")).where("n = 0")


def check_row_count(df: DataFrame, min_rows: int | None = None, max_rows: int | None = None):
    """One row with the row count if it is outside the bounds."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.where(out_of_range("n", min_rows, max_rows))


def check_distribution(
    df: DataFrame,
    col: str,
    bounds: Mapping[str, tuple[float | None, float | None]],
    approx: bool = False,
) -> DataFrame:
    """Statistics of a column that leave their bounds: (statistic, value, lower, upper).

    ``bounds`` maps 'mean', 'stddev', 'min', 'max' or a quantile such as 'p50' to limits.
    A quantile is the least value that this share of the values does not exceed.  It is found
    exactly by counting ranges, which reads the column a few times; ``approx`` takes the engine's one-pass sketch instead, within 1/10000 of the rank.
    """
    number = F.col(col).cast("double")

    def quantile(name: str) -> bool:
        return name.startswith("p")

    def statistic(name: str) -> Column:
        if quantile(name):
            return F.percentile_approx(number, float(name[1:]) / 100.0)
        if name == "mean":
            return F.sum(F.col(col)).cast("double") / F.nullif(F.count(col), F.lit(0))
        return {"stddev": F.stddev_samp, "min": F.min, "max": F.max}[name](number)

    exact = {} if approx else {n: float(n[1:]) / 100.0 for n in bounds if quantile(n)}
    plain = [statistic(n).cast("double").alias(n) for n in bounds if n not in exact]
    stats = df.agg(*plain) if plain else None
    if exact:
        cuts = exact_percentiles(df.select(col), [], col, exact, discrete=True)
        # one row each; a column without values has no percentiles
        one = F.lit(0).alias("_one")
        stats = cuts if stats is None else stats.select("*", one).join(cuts.select("*", one), "_one", "left")
    limits = F.array(
        *[
            F.struct(
                F.lit(name).alias("statistic"),
                F.col(name).alias("value"),
                F.lit(low).cast("double").alias("lower_bound"),
                F.lit(high).cast("double").alias("upper_bound"),
            )
            for name, (low, high) in bounds.items()
        ]
    )
    rows = stats.select(F.inline(limits))
    below = F.col("value") < F.col("lower_bound")
    above = F.col("value") > F.col("upper_bound")
    return rows.where(below | above)


def check_recency(df: DataFrame, col: str, days: int, as_of: dt.date | str) -> DataFrame:
    """One row if the newest value is more than ``days`` old (or there is none)."""
    newest = df.agg(F.max(F.col(col).cast("date")).alias("newest"))
    aged = newest.withColumn("age_days", days_between("newest", F.lit(str(as_of)).cast("date")))
    return aged.where(F.col("newest").isNull() | (F.col("age_days") > days))


def check_freshness(
    df: DataFrame, col: str, warn_days: int, error_days: int, as_of: dt.date | str, name: str
) -> DataFrame:
    """Age of the newest load with status pass, warn or error (error too if never loaded)."""
    newest = df.agg(F.max(F.col(col).cast("date")).alias("max_loaded_at"))
    return freshness_of(newest, warn_days, error_days, as_of, name)


def check_freshness_stored(
    spark: SparkSession, path: str, col: str, warn_days: int, error_days: int, as_of: dt.date | str, name: str
) -> DataFrame:
    """``check_freshness`` of a stored table by a date column, from the footers of its files."""
    newest = footer_bounds(spark, path, col).select(F.col("most").alias("max_loaded_at"))
    return freshness_of(newest, warn_days, error_days, as_of, name)


def freshness_of(
    newest: DataFrame, warn_days: int, error_days: int, as_of: dt.date | str, name: str
) -> DataFrame:
    """Status of a source whose newest load is the one row of ``newest``."""
    age = days_between("max_loaded_at", F.lit(str(as_of)).cast("date"))
    status = (
        F.when(age.isNull() | (age > error_days), "error").when(age > warn_days, "warn")
    ).otherwise("pass")
    return newest.select(
        F.lit(name).alias("source"),
        "max_loaded_at",
        age.alias("age_days"),
        status.alias("status"),
    )


def _off_by(actual: str, expected: Column) -> Column:
    return F.abs(F.col(actual) - expected)


def check_net_sales(metrics: DataFrame) -> DataFrame:
    """Orders whose net sales differ from gross minus refunds."""
    expected = F.col("gross_item_sales") - F.col("total_refund_amount")
    return metrics.select(
        "order_id",
        "gross_item_sales",
        "total_refund_amount",
        "net_sales",
        expected.alias("calculated_net_sales"),
        _off_by("net_sales", expected).alias("difference"),
    ).where(F.col("difference") > TOLERANCE)


def check_return_dates(returns: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Returns dated before their order."""
    lines = items.select("order_item_id", "order_id")
    return (
        returns.select("return_id", "order_item_id", "return_date")
        .join(lines, "order_item_id")
        .join(orders.select("order_id", "order_date"), "order_id")
        .where(F.col("return_date") < F.col("order_date"))
        .select("return_id", "return_date", "order_date", "order_id")
    )


def check_gross_sales(items: DataFrame) -> DataFrame:
    """Lines whose gross sales differ from quantity x unit price."""
    expected = F.col("quantity") * F.col("unit_price")
    return items.select(
        "order_item_id",
        "quantity",
        "unit_price",
        "gross_item_sales",
        expected.alias("calculated_gross_sales"),
        _off_by("gross_item_sales", expected).alias("difference"),
    ).where(F.col("difference") > TOLERANCE)
