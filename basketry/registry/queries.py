"""The registered queries: each maps (session, data folder) to a DataFrame.

Amounts leave as DOUBLE and load times as DATE, so results compare across engines; inside
the library they stay DECIMAL and TIMESTAMP.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import date_bounds, date_spine, recent_months, surrogate_key
from ..operators import checks
from ..operators.history import scd2_from_snapshots, scd2_merge, scd2_start
from ..operators.published import drop_unpublished
from ..operators.relational import (
    column_values,
    cumulative_share,
    pareto_shares,
    pivot_sum,
    share_of_total,
    top_k_by_rank,
    top_n,
    union_relations,
    unpivot,
)
from ..operators.series import (
    days_since_start,
    lag_value,
    rolling_avg,
    rolling_sum,
    running_total,
)
from ..operators.upsert import reprocess_window, rows_without_keys, upsert
from ..plans import daily, insight, marts, metrics, quality, refresh
from ..plans.staging import (
    stage_order_items,
    stage_orders,
    stage_products,
    stage_returns,
    stage_users,
)
from ..plans.warehouse import Warehouse
from ..session import fresh_path, stash, tune
from ..sources import RAW_COLUMNS, as_view, from_star, load_raw, read_raw, source, write_table
from ..streaming.jobs import event_stream, refresh_fct_orders_stream
from ..streaming.totals import compact_daily_revenue
from ..streaming.totals import daily_revenue as stream_totals
from ..streaming.totals import daily_revenue_stream as start_daily_revenue

Query = Callable[[SparkSession, str], DataFrame]

# The test tables hold larger amounts than retail baskets, so tiers use larger bounds.
VIP, GROWTH = 900_000, 400_000
AS_OF = "2001-08-01"
CUTOFF = "2001-06-01"
STAR_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]

QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Warehouse], DataFrame], name: str | None = None):
    """Register a function of a warehouse under its own name or ``name``."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        raw = from_star(tune(spark), folder)
        return portable(fn(Warehouse(raw, VIP, GROWTH)))

    QUERIES[name or fn.__name__] = run
    return fn


def query_as(name: str):
    return partial(query, name=name)


def table_query(fn: Query) -> Query:
    """Register a function that reads the given tables by itself."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(fn(tune(spark), folder))

    QUERIES[fn.__name__] = run
    return fn


def portable(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("date").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# --- staging ------------------------------------------------------------------------------


@query
def stg_users(wh):
    return wh.staged.users


@query
def stg_products(wh):
    return wh.staged.products


@query
def stg_orders(wh):
    return wh.staged.orders


@query
def stg_order_items(wh):
    return wh.staged.order_items


@query
def stg_returns(wh):
    return wh.staged.returns


# --- metrics and marts --------------------------------------------------------------------


@query
def returns_with_item(wh):
    return metrics.returns_with_item(wh.staged.returns, wh.staged.order_items)


@query
def returns_with_order(wh):
    s = wh.staged
    orders = s.orders.select("order_id", "user_id", "order_date", "status")
    return metrics.returns_with_order(s.returns, s.order_items, orders)


@query
def order_metrics(wh):
    return wh.fresh_order_metrics()


@query
def order_surrogate_key(wh):
    return wh.staged.orders.select(
        "order_id", surrogate_key("order_id", "user_id", "order_date").alias("order_surrogate_key")
    )


@query
def customer_lifetime(wh):
    return metrics.customer_lifetime(wh.staged.users, wh.fresh_order_metrics())


def _dim(wh):
    return marts.dim_customers(customer_lifetime(wh), wh.vip, wh.growth)


@query
def dim_customers(wh):
    return _dim(wh)


@query
def customer_segment_performance(wh):
    return marts.segment_performance(_dim(wh))


@query
def completed_items(wh):
    return metrics.completed_items(wh.staged.order_items, wh.staged.orders)


@query
def product_performance(wh):
    return wh.product_performance


@query
def mart_product_performance(wh):
    return marts.mart_product_performance(wh.product_performance)


@query
def dim_products(wh):
    return marts.dim_products(wh.staged.products, wh.product_performance)


@query
def primary_product(wh):
    return marts.primary_product(wh.staged.order_items, wh.staged.products)


@query
def primary_product_top_n(wh):
    totals = metrics.order_product_totals(wh.staged.order_items)
    order = [F.desc("product_quantity"), F.desc("product_sales"), F.asc("product_id")]
    return top_n(totals, ["order_id"], order, 1)


@query
def category_mix(wh):
    return marts.category_mix(wh.staged.order_items, wh.staged.products)


@query
def fct_orders(wh):
    return wh.fct_orders


# --- time series --------------------------------------------------------------------------


@query_as("date_bounds")
def date_bounds_of_orders(wh):
    return date_bounds(wh.staged.orders.where("is_completed"), "order_date")


@query_as("date_spine")
def date_spine_orders(wh):
    """Orders per day of a fixed range, days without orders included."""
    spine = date_spine(wh.staged.orders.sparkSession, "1995-01-01", "2002-01-01")
    per_day = wh.staged.orders.groupBy("order_date").agg(F.count("order_id").alias("n"))
    joined = spine.join(per_day, spine["date_day"] == per_day["order_date"], "left")
    return joined.select("date_day", F.coalesce("n", F.lit(0)).alias("order_count"))


def _daily(wh, **options):
    per_day = stash(daily.daily_revenue(wh.fct_orders), "daily-revenue")
    return daily.daily_on_spine(per_day, **options)


@query
def daily_revenue(wh):
    return daily.daily_revenue(wh.fct_orders)


@query
def daily_revenue_on_spine(wh):
    return _daily(wh, start="1994-12-25", end="2001-08-11")


@query
def daily_revenue_dense(wh):
    return _daily(wh, dense=True)


def _daily_by_status(wh):
    """Revenue per status and day: a series per status, as long as the calendar."""
    by_day = wh.fresh_order_metrics().groupBy("status", "order_date")
    return by_day.agg(F.sum("net_sales").alias("total_revenue"))


STATUS_SERIES = (["status"], ["order_date"], "total_revenue")


@query
def rolling_7day_avg(wh):
    return rolling_avg(_daily_by_status(wh), *STATUS_SERIES, "revenue_7day_avg")


@query
def rolling_30day_total(wh):
    return rolling_sum(_daily_by_status(wh), *STATUS_SERIES, "revenue_30day_total")


@query
def running_total_and_lag(wh):
    daily_rows = _daily_by_status(wh)
    running = running_total(daily_rows, *STATUS_SERIES, "running_revenue")
    return lag_value(running, *STATUS_SERIES, "previous_revenue")


@query
def days_since_segment_start(wh):
    first_day = wh.staged.orders.where("is_completed").join(
        wh.staged.users.select("user_id", "customer_segment"), "user_id"
    )
    days = first_day.select("customer_segment", "order_date").distinct()
    return days_since_start(days, ["customer_segment"], "order_date", "days_since_segment_start")


@query
def daily_revenue_summary(wh):
    return daily.daily_revenue_summary(wh.fct_orders, ordered=True)


@query
def daily_revenue_summary_dense(wh):
    return daily.daily_revenue_summary(wh.fct_orders, dense=True)


@query
def weekly_revenue(wh):
    per_day = daily.daily_revenue(wh.fct_orders)
    return daily.weekly_revenue(per_day.withColumnRenamed("order_date", "revenue_date"))


# --- set operations and reshaping ---------------------------------------------------------


@query
def unified_transactions(wh):
    return wh.unified_transactions


@query_as("union_relations")
def union_orders_returns(wh):
    return union_relations({"orders": wh.staged.orders, "returns": wh.staged.returns}).drop(
        "ingested_at"
    )


@query
def pivot_revenue(wh):
    return pivot_sum(
        _dim(wh), ["customer_segment"], "loyalty_tier", quality.TIERS, "lifetime_revenue"
    )


@query
def unpivot_metrics(wh):
    names = ["customer_count", "active_customer_count", "total_segment_revenue",
             "active_customer_ratio"]
    keys = ["customer_segment", "loyalty_tier"]
    wide = marts.segment_performance(_dim(wh)).select(
        *keys, *[F.col(n).cast("double").alias(n) for n in names]
    )
    return unpivot(wide, keys, names, "metric", "value")


@query_as("column_values")
def column_values_status(wh):
    return column_values(wh.staged.orders, "status")


# --- analysis -----------------------------------------------------------------------------


@query
def enriched_orders(wh):
    return wh.enriched_orders


@query
def monthly_segment_metrics(wh):
    return insight.monthly_segment_metrics(wh.enriched_orders)


@query
def segment_trends(wh):
    return insight.segment_trends(insight.monthly_segment_metrics(wh.enriched_orders))


@query
def segment_month_trend(wh):
    return insight.segment_month_trend(wh.enriched_orders)


@query
def product_segment_performance(wh):
    return insight.product_segment_performance(wh.enriched_orders)


@query
def top_products(wh):
    ranked = insight.product_segment_performance(wh.enriched_orders)
    return top_k_by_rank(ranked, "revenue_rank_in_category", 5)


@query
def customer_ltv_by_category(wh):
    return insight.customer_ltv_by_category(wh.enriched_orders)


@query
def ltv_statistics(wh):
    return insight.ltv_statistics(insight.customer_category_value(wh.enriched_orders))


@query
def customer_share_of_country(wh):
    """Running share of each customer in the revenue of the country, from the largest on."""
    active = _dim(wh).where("is_active_customer").select("customer_id", "country", "lifetime_revenue")
    by_revenue = [F.desc("lifetime_revenue"), F.asc("customer_id")]
    return cumulative_share(active, ["country"], by_revenue, "lifetime_revenue", "cumulative_pct")


@query
def customer_revenue_share(wh):
    """Share and running share of each customer in the revenue of the segment."""
    active = _dim(wh).where("is_active_customer").select(
        "customer_id", "customer_segment", "lifetime_revenue"
    )
    by_revenue = [F.desc("lifetime_revenue"), F.asc("customer_id")]
    return pareto_shares(
        active,
        ["customer_segment"],
        by_revenue,
        "lifetime_revenue",
        share="pct_of_segment",
        cumulative="cumulative_pct",
    )


@query
def segment_share_of_tier(wh):
    """Share of each segment in the revenue of its loyalty tier."""
    totals = marts.segment_performance(_dim(wh)).select(
        "customer_segment", "loyalty_tier", "total_segment_revenue"
    )
    totals = stash(totals, "segment-totals")
    return share_of_total(totals, ["loyalty_tier"], "total_segment_revenue", "pct_of_tier")


@query
def recent_orders(wh):
    return recent_months(wh.staged.orders, "order_date", AS_OF, 6)


@query
def high_value_opportunities(wh):
    return insight.high_value_opportunities(wh.enriched_orders)


@query
def segment_product_analysis(wh):
    return insight.segment_product_analysis(wh.fct_orders, wh.dim_customers, AS_OF)


# --- data quality (bounds are strict on purpose, so that there is something to find) -------


@query
def check_unique(wh):
    return checks.check_unique(wh.staged.orders, "user_id")


@query
def check_unique_combination(wh):
    return checks.check_unique_combination(
        wh.staged.order_items, ["order_id", "product_id", "quantity"]
    )


@query
def check_not_null(wh):
    mix = marts.order_product_mix(wh.order_products, wh.staged.products)
    orders = wh.staged.orders.select("order_id", "order_date").join(mix, "order_id", "left")
    return checks.check_not_null(orders, "primary_product_id").select("order_id", "order_date")


@query
def check_relationships(wh):
    done = wh.staged.orders.where("is_completed")
    lines = wh.staged.order_items.select("order_item_id", "order_id")
    return checks.check_relationship(lines, "order_id", done, "order_id")


@query
def check_accepted_values(wh):
    return checks.check_accepted_values(wh.staged.users, "customer_segment", STAR_SEGMENTS)


@query
def check_range(wh):
    lines = wh.staged.order_items.select("order_item_id", "quantity", "gross_item_sales")
    return checks.check_range(lines, "quantity", 3, 48)


@query
def check_net_sales(wh):
    """Header totals of the test tables do not follow the lines, so they fail the rule."""
    shifted = wh.fresh_order_metrics().withColumn("net_sales", F.col("order_total_amount"))
    return checks.check_net_sales(shifted)


@query
def check_return_dates(wh):
    s = wh.staged
    return checks.check_return_dates(s.returns, s.order_items, s.orders)


@query
def check_gross_sales(wh):
    """Gross sales replaced by the refund of returned lines, which is often smaller."""
    s = wh.staged
    refunds = s.returns.select("order_item_id", "refund_amount")
    lines = s.order_items.join(refunds, "order_item_id")
    return checks.check_gross_sales(
        lines.withColumn("gross_item_sales", F.col("refund_amount"))
    )


@query
def check_freshness(wh):
    """Users and products carry no load time in the test tables, which is an error."""
    return quality.freshness_report(dict(wh.raw.items()), as_of="2001-11-09")


@query
def check_expression(wh):
    lines = wh.staged.order_items.select("order_item_id", "unit_price")
    return checks.check_expression(lines, "unit_price >= 100")


@query
def check_recency(wh):
    return checks.check_recency(wh.staged.orders, "order_date", 3, "2001-12-01")


@query
def check_at_least_one(wh):
    """Orders without lines have no main product at all; those with lines have one."""
    lines = F.coalesce("line_item_count", F.lit(0))
    facts = stash(wh.fct_orders.select("line_item_count", "primary_product_id"), "main-products")
    found = checks.check_at_least_one(facts.where(lines == 0), "primary_product_id")
    other = checks.check_at_least_one(facts.where(lines > 0), "primary_product_id")
    named = found.withColumn("part", F.lit("without lines"))
    return named.unionByName(other.withColumn("part", F.lit("with lines")))


@query
def check_freshness_footers(wh):
    """Freshness of stored orders, lines and returns by their dates, from footers alone."""
    spark = wh.staged.orders.sparkSession
    s = wh.staged
    dated = {
        "orders": s.orders.select("order_id", F.col("order_date").alias("loaded_on")),
        "order_items": s.order_items.select("order_item_id", F.col("ingested_at").cast("date").alias("loaded_on")),
        "returns": s.returns.select("return_id", F.col("return_date").alias("loaded_on")),
    }
    found = []
    for name, df in dated.items():
        path = fresh_path(spark, f"stored-{name}")
        write_table(df, path, sort_by=["loaded_on", df.columns[0]])
        limits = quality.FRESHNESS[name]
        # a footer's answer belongs to a session of its own, so its one row is taken over
        row = checks.check_freshness_stored(spark, path, "loaded_on", *limits, as_of="2001-08-08", name=name)
        found += row.collect()
    return spark.createDataFrame(found, "source string, max_loaded_at date, age_days long, status string")


@query
def orders_clustered(wh):
    """Orders stored by month and clustered by date and customer, read back for some customers."""
    spark = wh.staged.orders.sparkSession
    orders = wh.staged.orders.drop("ingested_at").withColumn("order_month", F.trunc("order_date", "MM"))
    path = fresh_path(spark, "orders-clustered")
    stored = write_table(
        orders, path, partition_by="order_month", sort_by=["order_id"], cluster_by=["order_date", "user_id"]
    )
    return stored.where("user_id BETWEEN 100 AND 199")


@query
def check_row_count(wh):
    return checks.check_row_count(wh.staged.order_items, min_rows=1, max_rows=1000)


@query
def check_distribution(wh):
    bounds = {"mean": (0.0, 10.0), "min": (2.0, None), "max": (None, 40.0)}
    return checks.check_distribution(wh.staged.order_items, "quantity", bounds)


@query
def check_distribution_quantiles(wh):
    """Exact quantiles and the deviation of line sales; the median of quantity lies inside."""
    prices = {"p50": (0.0, 100.0), "p95": (0.0, 1000.0), "stddev": (None, 1.0), "p1": (None, 1e9)}
    found = checks.check_distribution(wh.staged.order_items, "gross_item_sales", prices)
    few = checks.check_distribution(wh.staged.order_items, "quantity", {"p50": (1.0, 50.0), "p90": (None, 2.0)})
    rounded = F.when(F.col("statistic") == "stddev", F.round("value", 4)).otherwise(F.col("value"))
    both = found.withColumn("column_name", F.lit("gross_item_sales"))
    return both.unionByName(few.withColumn("column_name", F.lit("quantity"))).withColumn("value", rounded)


@query
def quality_report(wh):
    """All declared checks of the raw and staged relations and the order metrics."""
    tables = {f"raw_{name}": df for name, df in wh.raw.items()}
    tables |= {f"stg_{name}": df for name, df in wh.staged.items()}
    tables["order_metrics"] = wh.order_metrics
    line_key = {"line_key": wh.raw.line_key}
    staged_from = {
        "stg_users": ("raw_users", stage_users),
        "stg_products": ("raw_products", stage_products),
        "stg_orders": ("raw_orders", stage_orders),
        "stg_order_items": ("raw_order_items", partial(stage_order_items, **line_key)),
        "stg_returns": ("raw_returns", partial(stage_returns, **line_key)),
    }
    return quality.run_checks(tables, quality.declared_rules(STAR_SEGMENTS), staged_from)


@query
def quality_report_marts(wh):
    """All declared checks of the dimensions, facts and marts."""
    facts = stash(wh.fct_orders, "fct-orders")
    performance = stash(wh.product_performance, "product-performance")
    tables = {
        "customer_lifetime": wh.fresh_customer_lifetime(),
        "product_performance": performance,
        "dim_customers": wh.dim_customers,
        "fct_orders": facts,
        "mart_product_performance": marts.mart_product_performance(performance),
        "segment_performance": marts.segment_performance(wh.dim_customers),
        "daily_revenue_summary": daily.daily_revenue_summary(facts),
        "unified_transactions": wh.unified_transactions,
    }
    return quality.run_checks(tables)


# --- incremental, stored and streaming ----------------------------------------------------


@query_as("reprocess_window")
def reprocess_window_orders(wh):
    orders = wh.staged.orders
    stored = orders.where(F.col("order_date") < F.lit(CUTOFF).cast("date"))
    return reprocess_window(orders, stored, "order_date", 14)


@query_as("upsert")
def upsert_orders(wh):
    """Orders of which the pending ones arrive again as cancelled."""
    orders = wh.staged.orders.drop("ingested_at")
    late = orders.where("status = 'pending'").withColumn("status", F.lit("cancelled"))
    return upsert(orders, late, ["order_id"])


# order-level columns: they do not depend on when the customer dimension was read
FACT_COLUMNS = [
    "order_id", "customer_id", "order_date", "status", "order_total_amount",
    "line_item_count", "distinct_categories", "gross_item_sales", "total_refund_amount",
    "net_sales", "return_count", "primary_product_id", "primary_product_sales",
]


@query
def fct_orders_incremental(wh):
    """Facts loaded up to a cutoff, then refreshed with the rolling window."""
    spark = wh.staged.orders.sparkSession
    path = fresh_path(spark, "fct-orders")
    stored = {"sold": wh.order_products, "metrics": wh.order_metrics}
    refresh.load_facts_until(path, wh.staged, wh.dim_customers, CUTOFF, **stored)
    table = refresh.refresh_fct_orders(path, wh.staged, wh.dim_customers)
    return table.select(*FACT_COLUMNS)


@query
def fct_orders_published(wh):
    """The incremental load into a catalog table whose months are switched to new versions."""
    spark = wh.staged.orders.sparkSession
    path, name = fresh_path(spark, "published-facts"), f"facts_{uuid.uuid4().hex}"
    stored = {"sold": wh.order_products, "metrics": wh.order_metrics}
    try:
        refresh.load_facts_until(path, wh.staged, wh.dim_customers, CUTOFF, table=name, **stored)
        facts = refresh.refresh_fct_orders(path, wh.staged, wh.dim_customers, table=name)
        drop_unpublished(spark, name, path)
        return stash(facts.select(*FACT_COLUMNS), "published-facts-read")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@query
def fct_orders_old_orders(wh):
    """Facts without the returns of a few old orders, which are then named and rebuilt."""
    spark = wh.staged.orders.sparkSession
    path, s = fresh_path(spark, "fct-orders"), wh.staged
    # stored, so that their size is known when the joins with all lines and returns are planned
    old = stash(s.orders.where("order_id % 500 = 3").select("order_id"), "old-orders")
    theirs = s.order_items.join(old, "order_id", "left_semi").select("order_item_id")
    theirs = stash(theirs.withColumn("line_key", metrics.line_key(s.order_items, s.returns)), "old-lines")
    before = s.replace(returns=s.returns.join(theirs.select("order_item_id"), "order_item_id", "left_anti"))
    known = wh.match_returns().join(theirs.select("line_key"), "line_key", "left_anti")
    stored = {"sold": wh.order_products, "returned": known}
    refresh.refresh_fct_orders(path, before, wh.dim_customers, **stored)
    table = refresh.refresh_fct_orders(path, s, wh.dim_customers, changed_order_ids=old)
    return table.select(*FACT_COLUMNS)


@query
def fct_orders_stream(wh):
    """Facts loaded up to a cutoff, then refreshed by a stream of arriving returns."""
    spark = wh.staged.orders.sparkSession
    path, inbox = fresh_path(spark, "fct-orders"), fresh_path(spark, "inbox")
    s = wh.staged
    late = s.returns.where(F.col("return_date") >= F.lit(CUTOFF).cast("date"))
    is_early = F.col("return_date") < F.lit(CUTOFF).cast("date")
    early = s.replace(returns=s.returns.where(is_early))
    known = metrics.some_returned_lines(wh.match_returns(is_early))
    stored = {"sold": wh.order_products, "returned": known}
    refresh.load_facts_until(path, early, wh.dim_customers, CUTOFF, **stored)
    schema = write_table(late.select("return_id", "order_item_id"), inbox).schema
    arriving = spark.readStream.schema(schema).parquet(inbox)
    run = refresh_fct_orders_stream(
        arriving, path, fresh_path(spark, "stream-state"), s, wh.dim_customers
    )
    run.awaitTermination()
    return spark.read.parquet(path).select(*FACT_COLUMNS)


@table_query
def daily_revenue_stream(spark, folder):
    """Events dealt to four files out of order, two files a batch."""
    inbox, path = fresh_path(spark, "event-files"), fresh_path(spark, "daily-events")
    given = spark.read.parquet(f"{folder}/events.parquet")
    given.repartition(4, F.xxhash64(*given.columns)).write.parquet(inbox)
    events = event_stream(spark, inbox, "*.parquet", files_per_batch=2)
    run = start_daily_revenue(events, path, fresh_path(spark, "stream-state"))
    run.awaitTermination()
    return stream_totals(spark, path)


@table_query
def daily_revenue_two_streams(spark, folder):
    """Two streams with checkpoints of their own, one of them started again, then compacted."""
    path, given = fresh_path(spark, "daily-events"), spark.read.parquet(f"{folder}/events.parquet")
    slot = F.pmod(F.xxhash64(*given.columns), F.lit(3))

    def arrive(inbox: str, state: str, part: int) -> None:
        rows = given.where(slot == part).repartition(3, F.xxhash64(*given.columns))
        rows.write.mode("append").parquet(inbox)
        events = event_stream(spark, inbox, "*.parquet", files_per_batch=1)
        start_daily_revenue(events, path, state, compact_every=2).awaitTermination()

    for parts in ([0, 1], [2]):
        inbox, state = fresh_path(spark, "event-files"), fresh_path(spark, "stream-state")
        for part in parts:
            arrive(inbox, state, part)
    compact_daily_revenue(spark, path)
    return stream_totals(spark, path)


@query
def fct_orders_stream_early_returns(wh):
    """Two batches of returns; the order lines of the first batch are there at the second only."""
    spark = wh.staged.orders.sparkSession
    path, inbox = fresh_path(spark, "fct-orders"), fresh_path(spark, "inbox")
    # the load and both batches read lines and returns several times, so their ids are made once
    lines = wh.staged.order_items.select("order_item_id", "order_id", "product_id", "quantity", "gross_item_sales")
    returns = wh.staged.returns.select("return_id", "order_item_id", "return_date", "refund_amount")
    s = wh.staged.replace(order_items=stash(lines, "stream-lines"), returns=stash(returns, "stream-returns"))
    wh.staged = s
    late = s.returns.where(F.col("return_date") >= F.lit(CUTOFF).cast("date"))
    is_early = F.col("return_date") < F.lit(CUTOFF).cast("date")
    early = s.replace(returns=s.returns.where(is_early))
    known = metrics.some_returned_lines(wh.match_returns(is_early))
    stored = {"sold": wh.order_products, "returned": known}
    refresh.load_facts_until(path, early, wh.dim_customers, CUTOFF, **stored)
    ids = late.select("return_id", "order_item_id")
    first = write_table(ids.where("order_item_id < '8'"), inbox)
    files = len(first.inputFiles())  # the files of the first batch come first, those of the second are no more
    unseen = stash(first.select("order_item_id"), "unseen-line-ids")
    write_table(ids.where("order_item_id >= '8'").coalesce(files), inbox, mode="append")
    before = s.replace(order_items=rows_without_keys(s.order_items, unseen, "order_item_id"))
    seen = iter([before])
    arriving = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", files).parquet(inbox)
    run = refresh_fct_orders_stream(
        arriving, path, fresh_path(spark, "stream-state"), lambda: next(seen, s), wh.dim_customers
    )
    run.awaitTermination()
    return spark.read.parquet(path).select(*FACT_COLUMNS)


@query
def write_read_partitioned(wh):
    spark = wh.staged.orders.sparkSession
    by_month = wh.staged.orders.drop("ingested_at").withColumn(
        "order_month", F.trunc("order_date", "MM")
    )
    path = fresh_path(spark, "orders-by-month")
    return write_table(
        by_month, path, partition_by="order_month", sort_by=["order_date", "user_id"]
    )


@query
def raw_csv_round_trip(wh):
    """Raw orders written as quoted CSV, read back as text and staged."""
    spark = wh.staged.orders.sparkSession
    folder = fresh_path(spark, "extracts")
    quoted = wh.raw.orders.write.option("header", True).option("quoteAll", True)
    quoted.option("escape", '"').csv(f"{folder}/raw_orders.csv")
    return stage_orders(read_raw(spark, folder, "orders"))


def _as_extract(df: DataFrame, table: str, folder: str, damage: dict, cut: Column, more: Column) -> None:
    """Write a raw relation as quoted lines that end with CRLF, some of them damaged.

    ``damage`` replaces the text of columns; a record with ``cut`` ends after two fields, one with ``more``
    has a field too many.
    """
    names = RAW_COLUMNS[table]
    texts = [damage.get(c, F.col(c).cast("string")) for c in names]
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(t, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for t in texts]
    whole, short = F.concat_ws(",", *quoted), F.concat_ws(",", *quoted[:2])
    line = F.when(cut, short).when(more, F.concat(whole, F.lit(',"?"'))).otherwise(whole)
    df.select(line.alias("value")).write.option("lineSep", "\r\n").text(f"{folder}/raw_{table}.csv")


def _load(wh, table: str, stage: Callable[..., DataFrame], damage: dict, cut: str, more: str, **key) -> DataFrame:
    """Staged rows of a damaged extract that has been loaded once, and its rejected records."""
    raw = getattr(wh.raw, table)
    spark = raw.sparkSession
    folder, out = fresh_path(spark, "extracts"), fresh_path(spark, "loaded")
    _as_extract(raw, table, folder, damage, F.expr(cut), F.expr(more))
    loaded = load_raw(spark, folder, table, out, header=False, line_key=wh.raw.line_key)
    counted = F.lit(loaded.row_count).cast("bigint"), F.lit(loaded.rejected_count).cast("bigint")
    rejected = loaded.rejected.select(
        F.lit("rejected").alias("outcome"), "record_key", F.concat_ws("; ", "reasons").alias("reasons")
    )
    rows = stage(source(spark, table, out), **key).drop("ingested_at").withColumn("outcome", F.lit("loaded"))
    both = rows.unionByName(rejected, allowMissingColumns=True)
    return both.withColumn("n_loaded", counted[0]).withColumn("n_rejected", counted[1])


def _damaged(column: str, where: str, text: str) -> Column:
    return F.when(F.expr(where), F.lit(text)).otherwise(F.col(column).cast("string"))


@query
def load_users(wh):
    """Sign-up dates are written as ISO or as month/day/year, and a few as neither."""
    day = F.expr("date_add(DATE '2020-01-01', CAST(user_id % 1000 AS INT))")
    signed = F.when(F.expr("user_id % 50 = 9"), "n/a").when(F.expr("user_id % 2 = 0"), F.date_format(day, "M/d/yyyy"))
    damage = {"signup_date": signed.otherwise(day.cast("string"))}
    return _load(wh, "users", stage_users, damage, "false", "user_id % 50 = 7")


@query
def load_products(wh):
    damage = {"cost": _damaged("cost", "product_id % 50 = 7", "free"), "product_id": _damaged("product_id", "product_id % 50 = 9", " ")}
    return _load(wh, "products", stage_products, damage, "false", "false")


@query
def load_orders(wh):
    damage = {"order_date": _damaged("order_date", "order_id % 50 = 7", "1999-02-30")}
    return _load(wh, "orders", stage_orders, damage, "order_id % 50 = 9", "false")


@query
def load_order_items(wh):
    damage = {
        "quantity": _damaged("quantity", "order_id % 50 = 7", "many"),
        "price": _damaged("price", "order_id % 100 = 7", "12,5"),
    }
    return _load(wh, "order_items", stage_order_items, damage, "false", "false", line_key=wh.raw.line_key)


@query
def load_returns(wh):
    damage = {"refund_amount": _damaged("refund_amount", "return_id < '1'", "x")}
    return _load(wh, "returns", stage_returns, damage, "false", "return_id >= 'f'", line_key=wh.raw.line_key)


@query
def orders_view_sql(wh):
    """Staged orders exposed as a view and read with SQL."""
    spark, name = wh.staged.orders.sparkSession, f"stg_orders_{uuid.uuid4().hex}"
    as_view(wh.staged.orders, name)
    read = spark.sql(f"SELECT order_id, status, is_completed FROM {name}")
    spark.catalog.dropTempView(name)  # the frame is resolved already
    return read


def _observed_costs(wh):
    """Highest unit price of each product per order month."""
    s = wh.staged
    dated = s.order_items.select("order_id", "product_id", "unit_price").join(
        s.orders.select("order_id", F.trunc("order_date", "MM").alias("seen_on")), "order_id"
    )
    return dated.groupBy("product_id", "seen_on").agg(F.max("unit_price").alias("unit_cost"))


@query
def product_cost_history(wh):
    return scd2_from_snapshots(_observed_costs(wh), "product_id", ["unit_cost"], "seen_on")


@query
def product_cost_merge(wh):
    """History of the yearly top price: two snapshots of all products merged in turn."""
    seen = stash(_observed_costs(wh), "observed-costs")

    def snapshot(first: str, end: str) -> DataFrame:
        inside = (F.col("seen_on") >= F.lit(first).cast("date")) & (
            F.col("seen_on") < F.lit(end).cast("date")
        )
        top = seen.where(inside).groupBy("product_id")
        return top.agg(F.max("unit_cost").alias("unit_cost"))

    history = stash(scd2_start(snapshot("1995-01-01", "1997-01-01"), "1997-01-01"), "history")
    history = scd2_merge(
        history, snapshot("1997-01-01", "1999-01-01"), "product_id", ["unit_cost"], "1999-01-01"
    )
    return scd2_merge(
        stash(history, "history"),
        snapshot("1999-01-01", "2002-01-01"),
        "product_id",
        ["unit_cost"],
        "2002-01-01",
        close_missing=True,
    )
