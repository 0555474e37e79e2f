"""Order-, customer- and product-level metrics.

Every rollup is aggregated to its key before it is joined, so joins are one row against
one row and a hot order, line or product has already shrunk on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import MONEY, match_key, mean_of, safe_divide, surrogate_key
from ..operators.upsert import rows_of_keys

HOT_LINES = 1_000_000  # lines of one order that are not gathered in one task


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


def _zero_money(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast(MONEY))


def returns_with_item(returns: DataFrame, items: DataFrame) -> DataFrame:
    """Each return with the order, product and quantity of its line."""
    lines = items.select("order_item_id", "order_id", "product_id", "quantity")
    return returns.drop("ingested_at").join(lines, "order_item_id")


def returns_with_order(returns: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Each return with its line and the columns of its order."""
    return returns_with_item(returns, items).join(orders, "order_id")


def order_product_totals(items: DataFrame) -> DataFrame:
    """Lines summed to order x product."""
    return items.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("product_quantity"),
        F.sum("gross_item_sales").alias("product_sales"),
        F.count(F.lit(1)).alias("product_lines"),
    )


def _has_hot_order(items: DataFrame) -> bool:
    """Whether one order, or the lines without one, may hold more than ``HOT_LINES`` lines.

    One scan of the order ids with a sketch of bounded size, which misses no frequent value.
    """
    top = F.expr("approx_top_k(order_id, 1, 10000)").alias("top")
    found = items.select("order_id").agg(top, F.count_if(F.col("order_id").isNull()).alias("none")).first()
    return max([found["none"], *(r["count"] for r in found["top"] or [])]) > HOT_LINES


def line_key(items: DataFrame, returns: DataFrame) -> Column:
    """The line id of both frames, short to shuffle where their types agree."""
    kind = items.schema["order_item_id"].dataType
    same = returns.schema["order_item_id"].dataType == kind
    return match_key(F.col("order_item_id"), kind) if same else F.col("order_item_id")


def returned_lines(
    items: DataFrame, returns: DataFrame, some: Column | None = None, few: bool = False
) -> DataFrame:
    """Order, product and quantity of the lines that have returns, with the sums of these.

    Returns are summed per line before the join, so many returns of one line cost one row;
    returns without a line are left out.  Store the rows where returns are summed more than
    once.  The returns that meet the condition ``some`` are summed apart as well, for ``some_returned_lines``.
    With ``few`` lines, which are stored, the returns of other lines are dropped before they are summed.
    """
    key = line_key(items, returns).alias("line_key")
    given = returns.select(
        key,
        F.col("return_id").isNotNull().alias("named"),
        "refund_amount",
        (F.lit(True) if some is None else F.coalesce(some, F.lit(False))).alias("some"),
    )
    if few:
        # summing per line then reuses the partitioning of this join, or needs no shuffle of
        # the other returns at all when the lines are few enough to broadcast
        given = rows_of_keys(given, items.select(key), "line_key")
    sums = [
        F.count_if("named").alias("return_count"),
        F.count(F.lit(1)).alias("return_rows"),
        F.sum("refund_amount").alias("refund_amount"),
    ]
    if some is not None:
        sums += [
            F.count_if(F.col("named") & F.col("some")).alias("some_count"),
            F.count_if("some").alias("some_rows"),
            F.sum(F.when(F.col("some"), F.col("refund_amount"))).alias("some_refund"),
        ]
    per_line = given.groupBy("line_key").agg(*sums)
    return items.select(key, "order_id", "product_id", "quantity").join(per_line, "line_key")


def some_returned_lines(returned: DataFrame) -> DataFrame:
    """The ``returned_lines`` of the returns that were summed apart."""
    sums = {"return_count": "some_count", "return_rows": "some_rows", "refund_amount": "some_refund"}
    lines = returned.where("some_rows > 0")
    return lines.select("order_id", "product_id", "quantity", *[F.col(c).alias(name) for name, c in sums.items()])


def order_product_rollup(
    items: DataFrame, returns: DataFrame, returned: DataFrame | None = None, few: bool = False
) -> DataFrame:
    """Lines and their returns summed to order x product.

    Order metrics, order facts and product performance all start from these rows, so store
    them where more than one is built.  Only line keys are shuffled to find the lines of the returns;
    the sums of lines and of returned lines then meet in one more shuffle.  It is by order, so that
    what is summed per order later shrinks before it is shuffled, and by order and product
    where one order is so large that it would fill a task.  ``returned`` are the ``returned_lines`` of
    these returns, where they are stored.
    """
    returned = (returned_lines(items, returns, few=few) if returned is None else returned).select(
        "order_id",
        "product_id",
        "return_count",
        (F.col("quantity") * F.col("return_rows")).alias("units_returned"),
        "refund_amount",
    )
    sold = items.select("order_id", "product_id", "quantity", "gross_item_sales", F.lit(1).alias("line"))
    rows = sold.unionByName(returned, allowMissingColumns=True)
    if not _has_hot_order(items):
        rows = rows.repartition("order_id")
    return rows.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("product_quantity"),
        F.sum("gross_item_sales").alias("product_sales"),
        F.count("line").alias("product_lines"),
        F.sum("return_count").alias("return_count"),
        F.sum("units_returned").alias("units_returned"),
        F.sum("refund_amount").alias("refund_amount"),
    )


def order_returns(items: DataFrame, returns: DataFrame, returned: DataFrame | None = None) -> DataFrame:
    """Returns summed to the order, for orders that have returned lines.

    ``returned`` are the ``returned_lines`` of these returns, where they are stored.
    """
    returned = returned_lines(items, returns) if returned is None else returned
    return returned.groupBy("order_id").agg(
        F.sum("return_count").alias("return_count"), F.sum("refund_amount").alias("total_refund_amount")
    )


def order_metrics(
    orders: DataFrame,
    items: DataFrame,
    returns: DataFrame,
    rollup: DataFrame | None = None,
    returned: DataFrame | None = None,
) -> DataFrame:
    """One row per order, cancelled ones included; measures of empty orders are 0.

    Lines are summed to order x product first (``rollup``, where it is stored) and then to the
    order: that gives the distinct product count without a second pass.  ``returned``
    (``order_returns``) takes the place of the returns in a rollup that was stored with others.
    """
    rollup = order_product_rollup(items, returns) if rollup is None else rollup
    sums = {"return_count": "return_count", "total_refund_amount": "refund_amount"} if returned is None else {}
    lines = rollup.groupBy("order_id").agg(
        F.sum("product_quantity").alias("total_item_quantity"),
        F.sum("product_lines").alias("line_item_count"),
        F.count("product_id").alias("distinct_products"),
        F.sum("product_sales").alias("gross_item_sales"),
        *[F.sum(c).alias(name) for name, c in sums.items()],
    )
    if returned is not None:
        lines = lines.join(returned, "order_id", "left")
    gross = _zero_money("gross_item_sales")
    refund = _zero_money("total_refund_amount")
    sums = orders.join(lines, "order_id", "left").select(
        "order_id",
        "user_id",
        "order_date",
        "status",
        "is_completed",
        F.col("total_amount").alias("order_total_amount"),
        _zero("total_item_quantity"),
        _zero("line_item_count"),
        _zero("distinct_products"),
        gross.alias("gross_item_sales"),
        refund.alias("total_refund_amount"),
        (gross - refund).cast("decimal(38,6)").alias("net_sales"),
        _zero("return_count"),
    )
    return with_order_key(sums)


def with_order_key(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("order_surrogate_key", surrogate_key("order_id", "user_id", "order_date"))


def customer_lifetime(users: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every user with totals over completed orders; dates stay NULL without one."""
    totals = (
        metrics.where("is_completed")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("completed_order_count"),
            F.sum("net_sales").alias("lifetime_revenue"),
            F.sum("total_item_quantity").alias("lifetime_units"),
            mean_of("net_sales").alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("most_recent_order_date"),
            F.sum("return_count").alias("total_return_count"),
            F.sum("total_refund_amount").alias("total_refunded_amount"),
        )
    )
    return users.join(totals, "user_id", "left").select(
        "user_id",
        "email",
        "signup_date",
        "country",
        "customer_segment",
        _zero("completed_order_count"),
        _zero_money("lifetime_revenue").alias("lifetime_revenue"),
        _zero("lifetime_units"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        "first_order_date",
        "most_recent_order_date",
        _zero("total_return_count"),
        _zero_money("total_refunded_amount").alias("total_refunded_amount"),
    )


def completed_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of completed orders.  Only line columns are kept, so a semi-join is enough."""
    done = orders.where("is_completed").select("order_id")
    return items.drop("ingested_at").join(done, "order_id", "left_semi")


def product_performance(
    products: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    returns: DataFrame,
    rollup: DataFrame | None = None,
) -> DataFrame:
    """Every product with sales of completed orders and returns of all orders.

    ``orders`` needs order_id and is_completed only, so staged orders serve as well as the
    order metrics.  A return counts the whole quantity of its line as returned.
    """
    rollup = order_product_rollup(items, returns) if rollup is None else rollup
    done = orders.where("is_completed").select("order_id", F.lit(True).alias("done")).distinct()
    totals = (
        rollup.join(done, "order_id", "left")
        .groupBy("product_id")
        .agg(
            F.count_if("done").alias("orders_sold"),
            F.sum(F.when(F.col("done"), F.col("product_quantity"))).alias("total_units_sold"),
            F.sum(F.when(F.col("done"), F.col("product_sales"))).alias("gross_sales"),
            F.sum("return_count").alias("return_count"),
            F.sum("units_returned").alias("units_returned"),
            F.sum("refund_amount").alias("total_refund_amount"),
        )
    )
    gross = _zero_money("gross_sales")
    refund = _zero_money("total_refund_amount")
    units = F.coalesce(F.col("total_units_sold"), F.lit(0))
    cogs = F.col("unit_cost") * units
    return (
        products.join(totals, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            "supplier_id",
            "unit_cost",
            _zero("orders_sold"),
            units.alias("total_units_sold"),
            gross.alias("gross_sales"),
            safe_divide(gross, "total_units_sold", default=None).alias("avg_unit_price_realized"),
            _zero("return_count"),
            _zero("units_returned"),
            refund.alias("total_refund_amount"),
            (gross - refund).alias("net_sales_after_returns"),
            cogs.alias("estimated_cogs"),
            (gross - cogs).alias("gross_profit_before_returns"),
            (gross - refund - cogs).alias("gross_profit_after_returns"),
        )
    )
