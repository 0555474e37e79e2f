"""Incremental refresh of the order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keymonths import within_key_ranges
from ..operators.published import merge_published, published_table
from ..operators.upsert import few_keys, near_keys, rows_of_keys, stored_table, window_floor, write_incremental
from ..relations import Relations
from ..session import stash
from .marts import fct_orders
from .metrics import line_key, order_metrics, order_product_rollup, order_returns


def orders_to_refresh(
    orders: DataFrame,
    target: DataFrame | None,
    days: int = 14,
    changed_order_ids: DataFrame | None = None,
    path: str | None = None,
) -> DataFrame:
    """Orders inside the rolling window, plus older ones named in ``changed_order_ids``.

    The window alone misses a return that comes in later than ``days`` after its order; pass
    the order ids such returns belong to, and those orders are rebuilt as well.
    """
    floor = window_floor(target, "order_date", days, path)
    if floor is None:
        return orders
    in_window = F.col("order_date") >= floor
    recent = orders.where(in_window)
    if changed_order_ids is None:
        return recent
    named = changed_order_ids.select("order_id").distinct()
    older = orders.where(~F.coalesce(in_window, F.lit(False)))
    return recent.unionByName(older.join(named, "order_id", "left_semi"))


def refresh_fct_orders(
    path: str,
    staged: Relations,
    customers: DataFrame,
    days: int = 14,
    changed_order_ids: DataFrame | None = None,
    table: str | None = None,
    sold: DataFrame | None = None,
    metrics: DataFrame | None = None,
    returned: DataFrame | None = None,
) -> DataFrame:
    """Rebuild the facts of recent (and named) orders and merge them into the table.

    The table is a folder of months, or with ``table`` a catalog table whose months are stored
    below ``path`` and published one by one when they have been written.

    Lines and returns are cut down to those orders before anything is aggregated.  Customers are the
    current dimension; facts of orders outside the scope keep the tier and lifetime
    figures they had when last merged.  Orders are never deleted.

    A first load can start from what is stored already: ``sold`` are the order x product rows of all staged
    lines (their returns are not used: those of ``staged`` are matched, or come
    as ``returned``, their stored ``returned_lines``), ``metrics`` those of the staged orders.
    """
    spark = staged.orders.sparkSession
    target = published_table(spark, table) if table else stored_table(spark, path)
    orders = orders_to_refresh(staged.orders, target, days, changed_order_ids, None if table else path)
    items, returns = staged.order_items, staged.returns
    if target is not None:
        orders = stash(orders, "orders-to-refresh")
        ids = orders.select("order_id")
        near = within_key_ranges(staged.order_items, ids, "order_id")
        key = line_key(items, returns)
        items = rows_of_keys(near, ids, "order_id")
        items = items.select(key.alias("order_item_id"), "order_id", "product_id", "quantity", "gross_item_sales")
        items = stash(items, "lines-to-refresh")
        returns = returns.withColumn("order_item_id", key)
    if target is not None or sold is None:
        sold = stash(order_product_rollup(items, returns, few=target is not None), "order-products")
        metrics = order_metrics(orders, items, returns, sold)
    elif metrics is None:
        metrics = order_metrics(orders, items, returns, sold, order_returns(items, returns, returned))
    facts = fct_orders(metrics, customers, sold, staged.products)
    layout = {"keys": ["order_id"], "date": "order_date", "sort_by": ["order_date", "customer_id"]}
    if table:
        return merge_published(facts, table, path, **layout)
    return write_incremental(facts, path, **layout)


def orders_of_returns(returns: DataFrame, items: DataFrame) -> DataFrame:
    """Ids of the orders the given returns belong to.

    The line ids are stored first: their size is then known when the join with the lines is
    planned, so a small batch is broadcast instead of shuffling all lines.
    """
    named = stash(returns.select("order_item_id").distinct(), "returned-line-ids")
    lines = items.select("order_item_id", "order_id")
    return lines.join(named, "order_item_id", "left_semi").select("order_id").distinct()


def load_facts_until(
    path: str,
    staged: Relations,
    customers: DataFrame,
    before: str,
    table: str | None = None,
    sold: DataFrame | None = None,
    metrics: DataFrame | None = None,
    returned: DataFrame | None = None,
) -> DataFrame:
    """First load of the fact table with the orders dated before ``before``.

    ``sold`` and ``metrics`` are stored rows of all staged lines and orders, ``returned`` those of the staged
    returns, as in ``refresh_fct_orders``.
    """
    is_early = F.col("order_date") < F.lit(before).cast("date")
    early = staged.replace(orders=staged.orders.where(is_early))
    metrics = None if metrics is None else metrics.where(is_early)
    return refresh_fct_orders(path, early, customers, table=table, sold=sold, metrics=metrics, returned=returned)


def match_returns(returns: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids of the orders the given returns belong to, and the line ids without a line so far."""
    key = line_key(items, returns)
    ids = returns.where("order_item_id IS NOT NULL").select("order_item_id").distinct()
    named = stash(ids.withColumn("line_key", key), "returned-line-ids")
    lines = items.select(key.alias("line_key"), "order_id")
    wanted = named.select("line_key")
    if few_keys(wanted):
        wanted = F.broadcast(wanted)  # lines are not shuffled for a usual batch
    else:
        lines = stash(near_keys(lines, wanted, "line_key"), "lines-near-returns")
    found = stash(lines.join(wanted, "line_key", "left_semi"), "returned-lines")
    return found.select("order_id").distinct(), named.join(found, "line_key", "left_anti").select("order_item_id")
