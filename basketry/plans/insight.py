"""Segment and product analysis: month trends, rankings, Pareto shares, customer value."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    days_between,
    growth_status,
    mean_of,
    month_start,
    opportunity_tier,
    pareto_class,
    percent_change,
    percent_of,
    recent_months,
    return_risk,
)
from ..operators.ordered import add_rank, chunked, exact_percentiles
from ..operators.relational import pareto_of_chunks, top_k_by_rank
from ..operators.series import lag_value, running_total
from ..session import stash

SERIES = ["customer_segment", "loyalty_tier", "primary_product_category"]
PERCENTILES = {
    "median_category_ltv": 0.5,
    "p75_category_ltv": 0.75,
    "p90_category_ltv": 0.9,
    "p95_category_ltv": 0.95,
}


def enrich_orders(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Completed orders with the current lifetime figures of their customer."""
    who = customers.select(
        "customer_id",
        F.col("lifetime_revenue").alias("customer_lifetime_revenue"),
        F.col("completed_order_count").alias("customer_total_orders"),
        F.col("avg_order_value").alias("customer_avg_order_value"),
        "engagement_band",
    )
    orders = facts.where("is_completed").select(
        "order_id",
        "order_date",
        "customer_id",
        "customer_segment",
        "loyalty_tier",
        "customer_country",
        "primary_product_id",
        "primary_product_name",
        "primary_product_category",
        "net_sales",
        "gross_item_sales",
        "total_refund_amount",
        "return_count",
        "total_item_quantity",
        "distinct_products",
    )
    return orders.join(who, "customer_id")


def monthly_segment_metrics(enriched: DataFrame) -> DataFrame:
    """Month x segment x tier x category totals, running segment revenue, previous row.

    Several rows share a month within a segment; tier and category settle their order, so
    the running total and the previous row are deterministic.  A segment has one row per
    month, tier and category, which bounds its window.
    """
    monthly = enriched.groupBy(month_start("order_date").alias("order_month"), *SERIES).agg(
        F.count("order_id").alias("order_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("net_sales").alias("total_net_sales"),
        F.sum("gross_item_sales").alias("total_gross_sales"),
        F.sum("total_refund_amount").alias("total_refunds"),
        F.sum("return_count").alias("total_returns"),
        F.sum("total_item_quantity").alias("total_units_sold"),
        mean_of("net_sales").alias("avg_order_value"),
    )
    order = [
        F.asc_nulls_first(c) for c in ("order_month", "loyalty_tier", "primary_product_category")
    ]
    segment = ["customer_segment"]
    out = running_total(
        monthly, segment, order, "total_net_sales", "segment_running_total_revenue"
    )
    return lag_value(out, segment, order, "total_net_sales", "previous_month_revenue")


def segment_trends(monthly: DataFrame) -> DataFrame:
    """Monthly metrics with growth, returns per 100 units and refunds per 100 of sales."""
    return monthly.withColumns(
        {
            "mom_growth_rate_pct": percent_change("total_net_sales", "previous_month_revenue"),
            "return_rate_pct": percent_of("total_returns", "total_units_sold"),
            "refund_rate_pct": percent_of("total_refunds", "total_gross_sales"),
        }
    )


def segment_month_trend(enriched: DataFrame) -> DataFrame:
    """Segment revenue month over month, one row per segment and month."""
    monthly = enriched.groupBy(
        "customer_segment", month_start("order_date").alias("order_month")
    ).agg(
        F.count("order_id").alias("order_count"),
        F.sum("net_sales").alias("total_net_sales"),
    )
    order = [F.asc_nulls_first("order_month")]
    segment = ["customer_segment"]
    out = running_total(monthly, segment, order, "total_net_sales", "running_revenue")
    out = lag_value(out, segment, order, "total_net_sales", "previous_month_revenue")
    growth = percent_change("total_net_sales", "previous_month_revenue")
    return out.withColumns(
        {
            "month_end": F.last_day("order_month"),
            "mom_growth_rate_pct": growth,
            "growth_status": growth_status(growth),
        }
    )


def product_segment_performance(enriched: DataFrame) -> DataFrame:
    """Main products by segment and tier with rank in category and Pareto share.

    A segment can have as many rows as there are products, so the rank and the cumulative
    share are computed over range-partitioned rows, not in one window task per segment.
    """
    sold = (
        enriched.where(F.col("primary_product_id").isNotNull())
        .groupBy(*SERIES, "primary_product_id", "primary_product_name")
        .agg(
            F.count("order_id").alias("order_count"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.sum("net_sales").alias("total_revenue"),
            F.sum("total_item_quantity").alias("total_units"),
            mean_of("net_sales").alias("avg_order_value"),
            F.sum("return_count").alias("total_returns"),
        )
    )
    segment = ["customer_segment"]
    order = [
        F.desc_nulls_last("total_revenue"),
        F.asc_nulls_first("loyalty_tier"),
        F.asc_nulls_first("primary_product_category"),
        F.asc("primary_product_id"),
        F.asc("primary_product_name"),
    ]
    # revenue falls within a category too, so one chunking serves the rank and the shares
    ranked = chunked(sold, segment, order).with_rank(
        [*segment, "primary_product_category"], "total_revenue", "revenue_rank_in_category"
    )
    return pareto_of_chunks(
        ranked,
        segment,
        order,
        "total_revenue",
        share="pct_of_segment_revenue",
        cumulative="cumulative_revenue_pct",
    )


def customer_category_value(enriched: DataFrame) -> DataFrame:
    """Orders, revenue and tenure of each customer in each main category."""
    return (
        enriched.where(F.col("primary_product_category").isNotNull())
        .groupBy("customer_id", *SERIES)
        .agg(
            F.count("order_id").alias("orders_in_category"),
            F.sum("net_sales").alias("category_lifetime_value"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
        )
        .withColumn("customer_tenure_days", days_between("first_order_date", "last_order_date"))
    )


def customer_ltv_by_category(enriched: DataFrame) -> DataFrame:
    """Customer value per category with its rank in segment and category."""
    return add_rank(
        customer_category_value(enriched),
        ["customer_segment", "primary_product_category"],
        "category_lifetime_value",
        "ltv_rank_in_segment_category",
        ties=["loyalty_tier", "customer_id"],
    )


def ltv_statistics(value: DataFrame, approx: bool = False) -> DataFrame:
    """Distribution of customer value by segment and category.

    Percentiles are exact and interpolated; ``approx`` uses one-pass sketches instead.
    """
    keys = ["customer_segment", "primary_product_category"]
    plain = [
        F.countDistinct("customer_id").alias("total_customers"),
        mean_of("category_lifetime_value").alias("avg_category_ltv"),
        F.max("category_lifetime_value").alias("max_category_ltv"),
        mean_of("orders_in_category").alias("avg_orders_per_customer"),
        mean_of("customer_tenure_days").alias("avg_tenure_days"),
    ]
    if approx:
        sketch = [
            F.percentile_approx("category_lifetime_value", p).cast("double").alias(name)
            for name, p in PERCENTILES.items()
        ]
        return value.groupBy(*keys).agg(*plain, *sketch)
    value = stash(value, "customer-value")
    cuts = exact_percentiles(
        value, keys, "category_lifetime_value", PERCENTILES, ties=["loyalty_tier", "customer_id"]
    )
    # segments may be NULL, and a struct key matches those too
    key = F.struct(*keys)
    cuts = cuts.select(key.alias("_key"), *PERCENTILES)
    stats = value.groupBy(*keys).agg(*plain).withColumn("_key", key)
    return stats.join(cuts, "_key", "left").drop("_key")


def high_value_opportunities(enriched: DataFrame) -> DataFrame:
    """Products VIP customers buy, labelled by number of buyers and mean order."""
    bought = (
        enriched.where(
            (F.col("loyalty_tier") == "VIP") & F.col("primary_product_id").isNotNull()
        )
        .groupBy(*SERIES, "primary_product_id", "primary_product_name")
        .agg(
            F.countDistinct("customer_id").alias("vip_customer_count"),
            F.sum("net_sales").alias("revenue_from_vip"),
            mean_of("net_sales").alias("avg_vip_order_value"),
        )
    )
    return bought.withColumn(
        "opportunity_tier", opportunity_tier("vip_customer_count", "avg_vip_order_value")
    )


def attach_top_products(trends: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """Left-join each month row to the ``k`` best products of its segment, tier, category."""
    best = top_k_by_rank(products, "revenue_rank_in_category", k).select(
        *SERIES,
        "primary_product_id",
        "primary_product_name",
        "revenue_rank_in_category",
        "pct_of_segment_revenue",
        "cumulative_revenue_pct",
    )
    return trends.join(best, SERIES, "left")


def segment_product_analysis(
    facts: DataFrame,
    customers: DataFrame,
    as_of: dt.date | str,
    months: int = 6,
    top_k: int = 5,
) -> DataFrame:
    """The report: recent month trends with top products, customer value and VIP demand.

    The enriched orders feed four branches, so they are stored once and read four times.
    """
    enriched = stash(enrich_orders(facts, customers), "enriched-orders")
    trends = segment_trends(monthly_segment_metrics(enriched))
    recent = recent_months(trends, "order_month", as_of, months)
    with_products = attach_top_products(recent, product_segment_performance(enriched), top_k)
    value = ltv_statistics(customer_category_value(enriched)).select(
        "customer_segment",
        "primary_product_category",
        "avg_category_ltv",
        "median_category_ltv",
        "p90_category_ltv",
        "avg_orders_per_customer",
    )
    demand = high_value_opportunities(enriched).select(
        *SERIES,
        "primary_product_id",
        "opportunity_tier",
        "revenue_from_vip",
        "vip_customer_count",
    )
    report = with_products.join(
        value, ["customer_segment", "primary_product_category"], "left"
    ).join(demand, [*SERIES, "primary_product_id"], "left")
    return report.select(
        "order_month",
        *SERIES,
        "total_net_sales",
        "total_gross_sales",
        "segment_running_total_revenue",
        "mom_growth_rate_pct",
        "order_count",
        "unique_customers",
        "avg_order_value",
        "total_returns",
        "return_rate_pct",
        "refund_rate_pct",
        "primary_product_id",
        "primary_product_name",
        "revenue_rank_in_category",
        "pct_of_segment_revenue",
        "cumulative_revenue_pct",
        "avg_category_ltv",
        "median_category_ltv",
        "p90_category_ltv",
        "avg_orders_per_customer",
        "opportunity_tier",
        "revenue_from_vip",
        "vip_customer_count",
        growth_status("mom_growth_rate_pct").alias("growth_status"),
        pareto_class("cumulative_revenue_pct").alias("pareto_classification"),
        return_risk("return_rate_pct").alias("return_risk_level"),
    ).orderBy(
        F.desc("order_month"),
        F.asc_nulls_last("customer_segment"),
        F.desc("total_net_sales"),
        F.asc_nulls_last("revenue_rank_in_category"),
    )
