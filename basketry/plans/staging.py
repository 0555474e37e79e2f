"""Staging: typed, renamed and case-normalised relations, one function per raw table.

Keys are BIGINT unless the extract says otherwise.  Casts run under ANSI mode, so a value
that does not fit its type raises instead of turning into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import MONEY, parse_date
from ..relations import Relations
from ..sources import RawTables


def _key(name: str, key_type: str = "bigint") -> Column:
    return F.col(name).cast(key_type).alias(name)


def _loaded_at() -> Column:
    return F.col("ingested_at").cast("timestamp").alias("ingested_at")


def stage_users(raw: DataFrame) -> DataFrame:
    return raw.select(
        _key("user_id"),
        F.lower("email").alias("email"),
        parse_date("signup_date").alias("signup_date"),
        F.upper("country").alias("country"),
        F.upper("customer_segment").alias("customer_segment"),
        _loaded_at(),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        _key("product_id"),
        "product_name",
        F.upper("category").alias("category"),
        _key("supplier_id"),
        F.col("cost").cast(MONEY).alias("unit_cost"),
        _loaded_at(),
    )


def stage_orders(raw: DataFrame) -> DataFrame:
    status = F.lower("status")
    return raw.select(
        _key("order_id"),
        _key("user_id"),
        F.col("order_date").cast("date").alias("order_date"),
        status.alias("status"),
        # an unknown status counts as not completed
        F.coalesce(status == "completed", F.lit(False)).alias("is_completed"),
        F.col("total_amount").cast(MONEY).alias("total_amount"),
        _loaded_at(),
    )


def stage_order_items(raw: DataFrame, line_key: str = "bigint") -> DataFrame:
    quantity = F.col("quantity").cast("int")
    price = F.col("price").cast(MONEY)
    return raw.select(
        _key("order_item_id", line_key),
        _key("order_id"),
        _key("product_id"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        (quantity * price).cast(MONEY).alias("gross_item_sales"),
        _loaded_at(),
    )


def stage_returns(raw: DataFrame, line_key: str = "bigint") -> DataFrame:
    return raw.select(
        _key("return_id", line_key),
        _key("order_item_id", line_key),
        F.col("return_date").cast("date").alias("return_date"),
        F.lower("return_reason").alias("return_reason"),
        F.col("refund_amount").cast(MONEY).alias("refund_amount"),
        _loaded_at(),
    )


def stage_all(raw: RawTables) -> Relations:
    """The five staged relations (lazy; nothing is stored at this layer)."""
    return Relations(
        users=lambda: stage_users(raw.users),
        products=lambda: stage_products(raw.products),
        orders=lambda: stage_orders(raw.orders),
        order_items=lambda: stage_order_items(raw.order_items, raw.line_key),
        returns=lambda: stage_returns(raw.returns, raw.line_key),
    )
