import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketry.functions import (
    date_bounds,
    date_spine,
    days_between,
    engagement_band,
    growth_status,
    loyalty_tier,
    month_start,
    opportunity_tier,
    pareto_class,
    parse_date,
    percent_change,
    percent_of,
    recent_months,
    return_risk,
    safe_divide,
    spine_over,
    subtract_days,
    surrogate_key,
    week_start,
)
from tests.conftest import day, rows


def one_column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_safe_divide(spark):
    df = spark.createDataFrame(
        [(1, 4), (1, 0), (1, None), (None, 2), (None, 0)], "a int, b int"
    )
    assert one_column(df, safe_divide("a", "b")) == [0.25, 0.0, 0.0, None, 0.0]
    assert one_column(df, safe_divide("a", "b", default=None)) == [0.25, None, None, None, None]
    assert one_column(df, safe_divide("a", "b", -1.0, as_percentage=True))[:2] == [25.0, -1.0]


def test_guarded_percentages(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (3, -2), (3, None)], "a int, b int")
    assert one_column(df, percent_change("a", "b")) == [50.0, None, None, None]
    assert one_column(df, percent_of("a", "b")) == [150.0, 0.0, 0.0, 0.0]


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = one_column(df, surrogate_key("x", "y"))
    assert len(set(keys)) == 3
    assert keys[2] == one_column(df, F.md5(F.lit("a-b")))[0]


def test_labels(spark):
    df = spark.createDataFrame(
        [(500.0,), (499.99,), (200.0,), (0.01,), (0.0,), (-5.0,), (None,)], "v double"
    )
    assert one_column(df, loyalty_tier("v")) == [
        "VIP", "GROWTH", "GROWTH", "NEW", "PROSPECT", "PROSPECT", "PROSPECT",
    ]
    counts = spark.createDataFrame([(5,), (4,), (2,), (1,), (0,)], "n int")
    assert one_column(counts, engagement_band("n")) == [
        "LOYAL", "ACTIVE", "ACTIVE", "NEW", "INACTIVE",
    ]
    growth = spark.createDataFrame(
        [(10.1,), (10.0,), (0.0,), (-10.0,), (-10.1,), (None,)], "g double"
    )
    assert one_column(growth, growth_status("g")) == [
        "Rapid Growth", "Growing", "Stable", "Stable", "Declining", "Stable",
    ]
    shares = spark.createDataFrame([(80.0,), (80.1,), (None,)], "p double")
    assert one_column(shares, pareto_class("p")) == [
        "Top 80% Product", "Long Tail Product", "Long Tail Product",
    ]
    risk = spark.createDataFrame([(15.1,), (15.0,), (5.0,), (None,)], "r double")
    assert one_column(risk, return_risk("r")) == [
        "High Return Risk", "Moderate Return Risk", "Low Return Risk", "Low Return Risk",
    ]
    demand = spark.createDataFrame(
        [(3, 100.0), (3, 99.0), (2, 50.0), (1, 500.0)], "n int, m double"
    )
    assert [x.split()[0] for x in one_column(demand, opportunity_tier("n", "m"))] == [
        "High", "Medium", "Medium", "Low",
    ]


def test_parse_date_accepts_both_forms_and_rejects_others(spark):
    df = spark.createDataFrame(
        [("1/5/2023",), ("12/31/2023",), ("2023-02-03",), (None,)], "d string"
    )
    assert one_column(df, parse_date("d")) == [
        day("2023-01-05"), day("2023-12-31"), day("2023-02-03"), None,
    ]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("soon",)], "d string").select(parse_date("d")).collect()


def test_date_parts(spark):
    df = spark.createDataFrame([(day("2023-05-03"),)], "d date")
    assert one_column(df, week_start("d")) == [day("2023-05-01")]
    assert one_column(df, month_start("d")) == [day("2023-05-01")]
    assert one_column(df, subtract_days("d", 14)) == [day("2023-04-19")]
    assert one_column(df, days_between(F.lit("2023-05-01").cast("date"), "d")) == [2]


def test_spine_excludes_its_end_and_has_no_gaps(spark):
    spine = date_spine(spark, "2023-05-01", "2023-08-31")
    days = [r[0] for r in spine.orderBy("date_day").collect()]
    assert len(days) == 122 and days[0] == day("2023-05-01") and days[-1] == day("2023-08-30")
    assert all((b - a).days == 1 for a, b in zip(days, days[1:]))
    assert date_spine(spark, "2023-05-01", "2023-05-01").count() == 0
    months = rows(date_spine(spark, "2023-01-01", "2023-04-01", "month"))
    assert months == [(day("2023-01-01"),), (day("2023-02-01"),), (day("2023-03-01"),)]


def test_spine_over_empty_bounds(spark):
    empty = spark.createDataFrame([], "order_date date")
    bounds = date_bounds(empty, "order_date")
    assert rows(bounds) == [(None, None)]
    assert spine_over(bounds, "min_date", "max_date").count() == 0


def test_recent_months_starts_on_a_month_boundary(spark):
    df = spark.createDataFrame([(day("2022-12-31"),), (day("2023-01-01"),), (None,)], "d date")
    assert rows(recent_months(df, "d", "2023-07-15", 6)) == [(day("2023-01-01"),)]
