"""Star schema and marts: customer and product dimensions, order facts, report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import engagement_band, loyalty_tier, mean_of, safe_divide
from ..functions.columns import GROWTH_REVENUE, VIP_REVENUE
from ..operators.relational import top_n
from .metrics import order_product_totals, returns_with_order


def dim_customers(
    lifetime: DataFrame, vip: float = VIP_REVENUE, growth: float = GROWTH_REVENUE
) -> DataFrame:
    return lifetime.withColumnRenamed("user_id", "customer_id").withColumns(
        {
            "loyalty_tier": loyalty_tier("lifetime_revenue", vip, growth),
            "engagement_band": engagement_band("completed_order_count"),
            "is_active_customer": F.col("most_recent_order_date").isNotNull(),
        }
    )


def dim_products(products: DataFrame, performance: DataFrame) -> DataFrame:
    """Catalogue attributes of every product with its sales totals."""
    totals = performance.select("product_id", "orders_sold", "total_units_sold", "gross_sales")
    return products.drop("ingested_at").join(totals, "product_id", "left").withColumn(
        "is_sold", F.coalesce(F.col("total_units_sold") > 0, F.lit(False))
    )


def _main_products(sold: DataFrame, products: DataFrame) -> DataFrame:
    """Per order the known product of largest quantity, then largest sales, then lowest id.

    ``sold`` has one row per order and product.  Only each task's best rows are shuffled, so an
    order holding a third of all lines costs few rows, and names are looked up for the best
    only.  A NULL quantity or sales figure is ordered first.
    """
    known = sold.join(products.select("product_id"), "product_id", "left_semi")
    less = [(-F.col(c)).asc_nulls_first() for c in ("product_quantity", "product_sales")]
    best = top_n(known, ["order_id"], [*less, F.asc("product_id")], 1)
    named = products.select("product_id", "product_name", "category")
    return best.join(named, "product_id").select(
        "order_id",
        F.col("product_id").alias("primary_product_id"),
        F.col("product_name").alias("primary_product_name"),
        F.col("category").alias("primary_product_category"),
        F.col("product_quantity").alias("primary_product_quantity"),
        F.col("product_sales").alias("primary_product_sales"),
    )


def _category_counts(sold: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct categories per order; lines of unknown products are left out."""
    known = sold.select("order_id", "product_id").join(products.select("product_id", "category"), "product_id")
    pairs = known.select("order_id", "category").distinct()
    return pairs.groupBy("order_id").agg(F.count("category").alias("distinct_categories"))


def order_product_mix(sold: DataFrame, products: DataFrame) -> DataFrame:
    """Per order: its main product and the number of distinct categories.

    ``sold`` has order x product rows and is read for both, so store it first.
    """
    return _main_products(sold, products).join(_category_counts(sold, products), "order_id", "left")


def primary_product(items: DataFrame, products: DataFrame) -> DataFrame:
    return _main_products(order_product_totals(items), products)


def category_mix(items: DataFrame, products: DataFrame) -> DataFrame:
    return _category_counts(items.select("order_id", "product_id"), products)


def fct_orders(
    metrics: DataFrame, customers: DataFrame, sold: DataFrame, products: DataFrame
) -> DataFrame:
    """Order facts: metrics with the customer's attributes and the order's main product.

    ``sold`` are the stored order x product rows, those the metrics were summed from.

    All orders are kept.  Product columns stay NULL for an order without known products and
    customer columns stay NULL for an unknown customer.
    """
    who = customers.select(
        F.col("customer_id").alias("user_id"),
        F.col("email").alias("customer_email"),
        F.col("country").alias("customer_country"),
        "customer_segment",
        "loyalty_tier",
        F.col("lifetime_revenue").alias("customer_lifetime_revenue"),
        F.col("completed_order_count").alias("customer_completed_order_count"),
        F.col("first_order_date").alias("customer_first_order_date"),
        F.col("most_recent_order_date").alias("customer_most_recent_order_date"),
    )
    return (
        metrics.join(order_product_mix(sold, products), "order_id", "left")
        .join(who, "user_id", "left")
        .select(
            "order_id",
            F.col("user_id").alias("customer_id"),
            "customer_email",
            "customer_country",
            "customer_segment",
            "loyalty_tier",
            "order_date",
            "status",
            "is_completed",
            "order_total_amount",
            "total_item_quantity",
            "line_item_count",
            "distinct_products",
            "distinct_categories",
            "gross_item_sales",
            "total_refund_amount",
            "net_sales",
            "return_count",
            "primary_product_id",
            "primary_product_name",
            "primary_product_category",
            "primary_product_quantity",
            "primary_product_sales",
            "customer_lifetime_revenue",
            "customer_completed_order_count",
            "customer_first_order_date",
            "customer_most_recent_order_date",
        )
    )


def mart_product_performance(performance: DataFrame) -> DataFrame:
    profit = "gross_profit_after_returns"
    return performance.withColumns(
        {
            "return_rate": safe_divide("units_returned", "total_units_sold"),
            "profit_margin_after_returns": safe_divide(profit, "gross_sales"),
            "roi_after_returns": safe_divide(profit, "estimated_cogs", default=None),
        }
    )


def segment_performance(customers: DataFrame) -> DataFrame:
    """Customer counts, revenue and refunds by segment and loyalty tier."""
    totals = customers.groupBy("customer_segment", "loyalty_tier").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.count_if("is_active_customer").alias("active_customer_count"),
        mean_of("lifetime_revenue").alias("avg_lifetime_revenue"),
        F.sum("lifetime_revenue").alias("total_segment_revenue"),
        mean_of("completed_order_count").alias("avg_completed_orders"),
        F.sum("total_refunded_amount").alias("total_segment_refunds"),
        mean_of("total_return_count").alias("avg_returns_per_customer"),
    )
    return totals.withColumns(
        {
            "active_customer_ratio": safe_divide("active_customer_count", "customer_count"),
            "refund_to_revenue_ratio": safe_divide(
                "total_segment_refunds", "total_segment_revenue"
            ),
        }
    )


def unified_transactions(
    facts: DataFrame, returns: DataFrame, items: DataFrame, ordered: bool = False
) -> DataFrame:
    """Completed orders (net amount) and all returns (negative refund) as one ledger.

    Order amounts are already net of refunds, so adding up both kinds counts a refund twice;
    filter on ``transaction_type`` to total one kind.  Ids become text where orders and
    returns have different key types.  ``ordered`` sorts by date (newest first) and id;
    leave it off when the result is stored or aggregated, as a stored table has no order.
    """
    id_types = {facts.schema["order_id"].dataType, returns.schema["return_id"].dataType}
    id_type = id_types.pop() if len(id_types) == 1 else "string"
    customers = facts.select("order_id", "customer_id")

    def entries(df: DataFrame, kind: str, key: str, date: str, amount: Column) -> DataFrame:
        return df.select(
            F.col(key).cast(id_type).alias("transaction_id"),
            F.col(date).alias("transaction_date"),
            "customer_id",
            F.lit(kind).alias("transaction_type"),
            amount.cast("decimal(38,6)").alias("transaction_amount"),
            F.col(date).alias("effective_date"),
        )

    sold = entries(
        facts.where("is_completed"), "order", "order_id", "order_date", F.col("net_sales")
    )
    refunded = entries(
        returns_with_order(returns, items, customers),
        "return",
        "return_id",
        "return_date",
        -F.col("refund_amount"),
    )
    ledger = sold.unionByName(refunded).withColumn(
        "source_table", F.lit("unified_transactions")
    )
    if ordered:
        return ledger.orderBy(F.desc_nulls_last("transaction_date"), "transaction_id")
    return ledger
