"""Each check must fire on corrupted rows and stay silent on clean ones."""

import pytest
from pyspark.sql import functions as F

from basketry.operators import checks as c
from basketry.plans import quality
from basketry.plans.warehouse import Warehouse
from tests import shop
from tests.conftest import day, rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (1, "b", -1.0), (2, None, 11.0), (None, "z", None), (None, "z", 10.0)],
        "k int, s string, v double",
    )


def test_unique_ignores_nulls_but_combinations_do_not(df):
    assert rows(c.check_unique(df, "k")) == [(1, 2)]
    assert rows(c.check_unique_combination(df, ["k", "s"])) == [(None, "z", 2)]


def test_not_null(df):
    assert c.check_not_null(df, "s").count() == 1


def test_relationship_lets_null_pass(spark, df):
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r.k for r in c.check_relationship(df, "k", parent, "id").collect()] == [2]


def test_accepted_values(df):
    assert rows(c.check_accepted_values(df, "s", ["a", "b"])) == [("z", 2)]


def test_range_reports_both_sides(df):
    assert sorted(r.v for r in c.check_range(df, "v", 0, 10).collect()) == [-1.0, 11.0]
    assert sorted(r.v for r in c.check_range(df, "v", 5, 10, inclusive=False).collect()) == [
        -1.0, 5.0, 10.0, 11.0,
    ]
    assert c.check_range(df, "v", min_value=0).count() == 1
    assert c.check_range(df, "v").count() == 0


def test_expression_and_counts(spark, df):
    assert c.check_expression(df, "v < 10").count() == 2
    assert c.check_at_least_one(df, "k").count() == 0
    assert c.check_at_least_one(df.limit(0), "k").count() == 1
    assert c.check_row_count(df, 1, 10).count() == 0
    assert rows(c.check_row_count(df, min_rows=6)) == [(5,)]
    assert rows(c.check_row_count(df, max_rows=4)) == [(5,)]


def test_distribution(df):
    bad = c.check_distribution(
        df, "v", {"mean": (0, 10), "max": (None, 10), "p50": (6, None), "stddev": (0, 100)}
    )
    assert [(s, v) for s, v, *_ in rows(bad)] == [("max", 11.0), ("p50", 5.0)]


def test_recency_and_freshness(spark):
    df = spark.createDataFrame([(day("2024-01-01"),), (None,)], "d date")
    assert c.check_recency(df, "d", 5, "2024-01-06").count() == 0
    assert [r.age_days for r in c.check_recency(df, "d", 5, "2024-01-07").collect()] == [6]
    assert c.check_recency(df.limit(0), "d", 5, "2024-01-07").count() == 1
    for as_of, status in (("2024-01-08", "pass"), ("2024-01-09", "warn"), ("2024-01-16", "error")):
        assert c.check_freshness(df, "d", 7, 14, as_of, "x").first().status == status
    assert c.check_freshness(df.limit(0), "d", 7, 14, "2024-01-08", "x").first().status == "error"


def test_business_rules(spark):
    wh = Warehouse(shop.raw(spark))
    s = wh.staged
    assert c.check_net_sales(wh.order_metrics).count() == 0
    assert c.check_gross_sales(s.order_items).count() == 0
    assert c.check_return_dates(s.returns, s.order_items, s.orders).count() == 0
    wrong = wh.order_metrics.selectExpr("* except (net_sales)", "net_sales + 0.02 AS net_sales")
    assert c.check_net_sales(wrong).count() == 7
    near = wh.order_metrics.selectExpr("* except (net_sales)", "net_sales + 0.01 AS net_sales")
    assert c.check_net_sales(near).count() == 0
    lines = s.order_items.selectExpr("* except (quantity)", "quantity + 1 AS quantity")
    assert c.check_gross_sales(lines).count() == 8
    early = s.returns.selectExpr("* except (return_date)", "date '2024-01-01' AS return_date")
    assert c.check_return_dates(early, s.order_items, s.orders).count() == 3


def test_run_checks_finds_the_planted_defects(spark):
    wh = Warehouse(shop.raw(spark))
    s = wh.staged
    report = quality.run_checks(
        {
            "stg_users": s.users,
            "stg_products": s.products,
            "stg_orders": s.orders,
            "stg_order_items": s.order_items,
            "stg_returns": s.returns,
            "dim_customers": wh.dim_customers,
            "fct_orders": wh.fct_orders,
        }
    )
    failed = {
        (r.table_name, r.check_name, r.column_name): r.violations
        for r in report.where("status = 'fail'").collect()
    }
    assert failed == {
        ("stg_orders", "relationships", "user_id"): 1,
        ("stg_order_items", "relationships", "product_id"): 1,
        ("fct_orders", "relationships", "customer_id"): 1,
    }


def test_reports_of_empty_and_derived_tables(spark):
    """One pass for a table and what is derived from it; empty tables break nothing."""
    raw = spark.createDataFrame([("1", "5"), ("1", None), (None, "9"), ("3", "x")], "id string, parent string")
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        passes.add(1)
        yield from batches

    raw = raw.coalesce(1).mapInArrow(seen, raw.schema)
    top = spark.createDataFrame([("5",), ("9",)], "id string")
    rules = {
        "raw": quality.not_null("id"),
        "staged": [quality.Unique(["id"]), *quality.not_null("id"), quality.Reference("parent", "top", "id"), quality.in_range("n", high=1)],
        "top": [quality.Unique(["id"])],
        "none": [*quality.not_null("id"), quality.Unique(["id"]), quality.Reference("id", "top", "id")],
        "alone": quality.not_null("id"),
    }

    def stage(df):
        return df.withColumn("n", F.length("id"))

    tables = {"raw": raw, "staged": stage(raw), "top": top, "none": top.limit(0), "alone": top}
    report = quality.run_checks(tables, rules, {"staged": ("raw", stage)})
    got = {(r.table_name, r.check_name, r.column_name): r.violations for r in report.collect()}
    assert passes.value == 1
    assert got == {
        ("raw", "not_null", "id"): 1, ("staged", "unique", "id"): 1, ("staged", "not_null", "id"): 1,
        ("staged", "relationships", "parent"): 1, ("staged", "accepted_range", "n"): 0,
        ("top", "unique", "id"): 0, ("none", "not_null", "id"): 0, ("none", "unique", "id"): 0,
        ("none", "relationships", "id"): 0, ("alone", "not_null", "id"): 0,
    }
