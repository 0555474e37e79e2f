"""Staging, metrics, marts and analysis on the small shop."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketry.plans import daily, insight, marts, metrics
from basketry.plans.staging import stage_orders
from basketry.plans.warehouse import Warehouse, build_warehouse
from tests import shop
from tests.conftest import day, money


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(shop.raw(spark))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_staging(spark, wh):
    users = by(wh.staged.users, "user_id")
    assert users[1].email == "ann@mail.com" and users[1].country == "USA"
    assert users[1].signup_date == day("2024-01-15") and users[2].signup_date == day("2024-02-03")
    assert users[3].customer_segment is None
    orders = by(wh.staged.orders, "order_id")
    assert orders[100].is_completed and not orders[102].is_completed
    assert orders[102].status == "cancelled" and orders[105].is_completed is False
    item = by(wh.staged.order_items, "order_item_id")[1004]
    assert item.gross_item_sales == money("360.000000") == item.quantity * item.unit_price
    types = dict(wh.staged.order_items.dtypes)
    assert types["gross_item_sales"] == "decimal(28,6)" and types["order_id"] == "bigint"


def test_staging_rejects_bad_values(spark):
    bad = spark.createDataFrame(
        [("x1", "1", "2024-01-02", "completed", "1.0", shop.T0)],
        "order_id string, user_id string, order_date string, status string, "
        "total_amount string, ingested_at string",
    )
    with pytest.raises(PySparkException):
        stage_orders(bad).collect()


def test_order_metrics(wh):
    m = by(wh.order_metrics, "order_id")
    assert len(m) == 7
    assert (m[100].gross_item_sales, m[100].total_refund_amount) == (140, 130)
    assert m[100].return_count == 2 and m[100].net_sales == 10
    assert (m[103].line_item_count, m[103].distinct_products) == (2, 1)
    assert m[104].net_sales == -2
    empty = m[106]
    assert (empty.line_item_count, empty.gross_item_sales, empty.return_count) == (0, 0, 0)


def test_customer_lifetime_and_dimension(wh):
    c = by(wh.dim_customers, "customer_id")
    assert len(c) == 4
    assert (c[1].lifetime_revenue, c[1].completed_order_count) == (40, 2)
    assert c[1].avg_order_value == 20.0 and c[1].first_order_date == day("2024-01-02")
    assert (c[2].loyalty_tier, c[2].engagement_band) == ("VIP", "NEW")
    assert (c[4].loyalty_tier, c[4].engagement_band) == ("PROSPECT", "INACTIVE")
    assert c[4].is_active_customer is False and c[4].first_order_date is None
    assert c[3].is_active_customer and c[3].loyalty_tier == "PROSPECT"


def test_product_performance(wh):
    p = by(marts.mart_product_performance(wh.product_performance), "product_id")
    desk = p[11]
    assert (desk.orders_sold, desk.total_units_sold, desk.gross_sales) == (3, 13, 735)
    assert (desk.return_count, desk.units_returned, desk.total_refund_amount) == (2, 4, 130)
    assert desk.estimated_cogs == 650 and desk.gross_profit_after_returns == -45
    assert desk.return_rate == pytest.approx(4 / 13)
    vase = p[13]
    assert vase.avg_unit_price_realized is None and vase.return_rate == 0.0
    assert vase.roi_after_returns is None and vase.profit_margin_after_returns == 0.0
    dims = by(marts.dim_products(wh.staged.products, wh.product_performance), "product_id")
    assert dims[11].is_sold and not dims[13].is_sold


def test_fact_table(wh):
    f = by(wh.fct_orders, "order_id")
    assert len(f) == 7
    assert f[100].primary_product_id == 11 and f[100].distinct_categories == 2
    assert f[101].primary_product_id == 11  # full tie: lower id
    assert f[103].primary_product_quantity == 10 and f[103].primary_product_sales == 600
    assert f[104].customer_email is None and f[104].loyalty_tier is None
    assert f[105].primary_product_id is None and f[105].line_item_count == 1
    assert f[106].distinct_categories is None


def test_huge_order_and_hot_return_line(spark, wh):
    """One order with most lines and one line with most returns keep exact totals."""
    s = wh.staged
    copies = spark.range(300).select(F.col("id").cast("int").alias("i"))
    lines = s.order_items.where("order_item_id = 1000").drop("order_item_id")
    many = lines.join(copies, F.col("i") >= 0).withColumn("order_item_id", F.col("i") + 9000)
    items = s.order_items.unionByName(many.drop("i"))
    back = s.returns.where("return_id = 5000").drop("return_id")
    returns = s.returns.unionByName(
        back.join(copies, F.col("i") >= 0).withColumn("return_id", F.col("i") + 7000).drop("i")
    )
    m = by(metrics.order_metrics(s.orders, items, returns), "order_id")[100]
    assert m.line_item_count == 302 and m.gross_item_sales == 140 + 300 * 20
    assert m.return_count == 302 and m.total_refund_amount == 130 + 300 * 60


def test_segment_performance(wh):
    seg = {
        (r.customer_segment, r.loyalty_tier): r
        for r in marts.segment_performance(wh.dim_customers).collect()
    }
    assert seg[("BASIC", "PROSPECT")].active_customer_ratio == 0.0
    assert seg[("BASIC", "VIP")].total_segment_revenue == 600
    assert seg[("PREMIUM", "NEW")].refund_to_revenue_ratio == pytest.approx(130 / 40)
    assert (None, "PROSPECT") in seg


def test_unified_transactions(wh):
    led = marts.unified_transactions(
        wh.fct_orders, wh.staged.returns, wh.staged.order_items, ordered=True
    ).collect()
    assert len(led) == 5 + 3
    assert [r.transaction_date for r in led] == sorted(
        (r.transaction_date for r in led), reverse=True
    )
    refund = next(r for r in led if r.transaction_id == 5002)
    assert refund.transaction_amount == -12 and refund.customer_id == 9
    assert refund.transaction_type == "return" and refund.effective_date == day("2024-02-12")


def test_daily_summary_fills_days(wh):
    out = daily.daily_revenue_summary(wh.fct_orders, "2024-01-01", "2024-02-15", ordered=True)
    got = out.collect()
    days = {r.revenue_date for r in got}
    assert len(days) == 45 and day("2024-02-15") not in days
    blank = next(r for r in got if r.revenue_date == day("2024-01-03"))
    assert blank.customer_segment is None and blank.total_revenue == 0
    assert blank.avg_order_value is None
    # unknown customer's order shares the NULL segment with the empty days
    assert any(r.revenue_date == day("2024-02-11") and r.total_revenue == -2 for r in got)


def test_daily_summary_defaults_to_the_data_range(wh):
    out = daily.daily_revenue_summary(wh.fct_orders)
    first, last = out.agg(F.min("revenue_date"), F.max("revenue_date")).first()
    assert (first, last) == (day("2024-01-02"), day("2024-02-13"))


def test_dense_series_roll_over_days(wh):
    out = daily.daily_revenue_summary(wh.fct_orders, dense=True)
    series = out.groupBy(*daily.DIMS).count().collect()
    assert {r["count"] for r in series} == {43}
    ann = out.where("customer_segment = 'PREMIUM'").orderBy("revenue_date").collect()
    by_day = {r.revenue_date: r for r in ann}
    assert by_day[day("2024-01-08")].revenue_7day_avg == pytest.approx(10 / 7)
    assert by_day[day("2024-01-09")].revenue_7day_avg == 0.0
    assert by_day[day("2024-01-20")].revenue_30day_total == 40
    assert by_day[day("2024-01-20")].days_since_segment_start == 18


def test_weekly_revenue(wh):
    per_day = daily.daily_revenue(wh.fct_orders).withColumnRenamed("order_date", "revenue_date")
    weeks = daily.weekly_revenue(per_day).collect()
    assert {r.week_start_date.weekday() for r in weeks} == {0}
    assert sum(r.total_revenue for r in weeks) == 10 + 30 + 600 - 2 + 0


def test_month_trends(wh):
    enriched = wh.enriched_orders
    assert enriched.count() == 4  # the order of the unknown user drops out
    trend = {
        (r.customer_segment, r.order_month): r
        for r in insight.segment_trends(insight.monthly_segment_metrics(enriched)).collect()
    }
    premium = trend[("PREMIUM", day("2024-01-01"))]
    assert premium.total_net_sales == 40 and premium.previous_month_revenue is None
    assert premium.mom_growth_rate_pct is None
    assert premium.return_rate_pct == pytest.approx(2 / 6 * 100)
    none = trend[(None, day("2024-02-01"))]
    assert none.return_rate_pct == 0.0 and none.refund_rate_pct == 0.0
    months = insight.segment_month_trend(enriched).where("customer_segment = 'BASIC'").first()
    assert months.month_end == day("2024-02-29") and months.growth_status == "Stable"


def test_ltv_statistics_exact_and_approximate(wh):
    value = insight.customer_category_value(wh.enriched_orders)
    exact = by(insight.ltv_statistics(value), "customer_segment")
    rough = by(insight.ltv_statistics(value, approx=True), "customer_segment")
    assert exact["PREMIUM"].median_category_ltv == 40.0 == rough["PREMIUM"].median_category_ltv
    assert exact["BASIC"].max_category_ltv == 600


def test_high_value_opportunities(wh):
    (only,) = insight.high_value_opportunities(wh.enriched_orders).collect()
    assert only.primary_product_id == 11 and only.opportunity_tier == "Low Opportunity"


def test_analysis_window_is_relative_to_as_of(wh):
    args = (wh.fct_orders, wh.dim_customers)
    full = insight.segment_product_analysis(*args, as_of="2024-03-01").collect()
    assert {r.order_month for r in full} == {day("2024-01-01"), day("2024-02-01")}
    vip = next(r for r in full if r.loyalty_tier == "VIP")
    assert vip.vip_customer_count == 1 and vip.pareto_classification == "Long Tail Product"
    assert insight.segment_product_analysis(*args, as_of="2025-03-01").count() == 0


def test_build_warehouse_equals_lazy_models(spark, wh, tmp_path):
    stored = build_warehouse(shop.raw(spark), str(tmp_path), as_of="2024-03-01")
    facts = stored["fct_orders"].drop("order_month")
    want = wh.fct_orders.select(*facts.columns)
    assert sorted(map(str, facts.collect())) == sorted(map(str, want.collect()))
    assert stored["unified_transactions"].count() == 8
    assert stored["segment_performance"].count() == 4
