"""Raw relations: quoted CSV extracts, stored source tables, and the star-schema adapter."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import MONEY, surrogate_key
from ..relations import Relations

# The columns of each raw extract, in file order.
RAW_COLUMNS = {
    "users": ["user_id", "email", "signup_date", "country", "customer_segment", "ingested_at"],
    "products": ["product_id", "product_name", "category", "supplier_id", "cost", "ingested_at"],
    "orders": ["order_id", "user_id", "order_date", "status", "total_amount", "ingested_at"],
    "order_items": [
        "order_item_id", "order_id", "product_id", "quantity", "price", "ingested_at",
    ],
    "returns": [
        "return_id", "order_item_id", "return_date", "return_reason", "refund_amount",
        "ingested_at",
    ],
}


class RawTables(Relations):
    """The five raw relations.  ``line_key`` is the type of order-line and return ids."""

    def __init__(self, line_key: str = "bigint", **builders: Callable[[], DataFrame]):
        super().__init__(**builders)
        self.line_key = line_key


def read_raw(spark: SparkSession, folder: str, table: str, prefix: str = "raw_") -> DataFrame:
    """Read one extract as text; types are applied in staging, where a bad value raises."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')  # a quote inside a field is doubled
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(f"{folder}/{prefix}{table}.csv")
    )


def raw_extracts(spark: SparkSession, folder: str, prefix: str = "raw_") -> RawTables:
    return RawTables(
        **{t: (lambda t=t: read_raw(spark, folder, t, prefix)) for t in RAW_COLUMNS}
    )


def source(
    spark: SparkSession,
    name: str,
    location: str | None = None,
    identifiers: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a declared source: a parquet folder, or a catalog table under its identifier.

    ``identifiers`` maps the declared name to the stored one (default: ``raw_<name>``).
    """
    stored = (identifiers or {}).get(name, f"raw_{name}")
    if location is None:
        return spark.table(stored)
    return spark.read.parquet(f"{location.rstrip('/')}/{stored}")


def _cents(amount: str) -> Column:
    return F.col(amount).cast("decimal(18,2)")


def _unit_price() -> Column:
    """Extended price / quantity as a six-place decimal; NULL for a zero quantity."""
    quantity = F.col("l_quantity").cast("decimal(10,0)")
    return (_cents("l_extendedprice") / F.nullif(quantity, F.lit(0))).cast(MONEY)


def _line_id() -> Column:
    """Order lines have no single key; these parts together tell them apart."""
    return surrogate_key(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        _cents("l_extendedprice"),
        F.col("l_shipdate").cast("date"),
    )


def _users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    country = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return customer.join(country, "c_nationkey", "left").select(
        F.col("c_custkey").alias("user_id"),
        F.concat("c_name", F.lit("@Example.com")).alias("email"),
        F.lit(None).cast("string").alias("signup_date"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
    )


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("bigint").alias("supplier_id"),
        _cents("p_retailprice").alias("cost"),
        F.lit(None).cast("timestamp").alias("ingested_at"),
    )


def _orders(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(status == "F", "Completed")
        .when(status == "O", "Processing")
        .when(status == "P", "Pending")
        .otherwise(status)
        .alias("status"),
        _cents("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").cast("timestamp").alias("ingested_at"),
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _line_id().alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        _unit_price().alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
    )


def _returns(lineitem: DataFrame) -> DataFrame:
    kept_share = F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)")
    reason = F.when(F.col("l_linestatus") == "O", "Defective").otherwise("Changed_Mind")
    line_id = _line_id()
    return lineitem.where(F.col("l_returnflag") == "R").select(
        line_id.alias("return_id"),
        line_id.alias("order_item_id"),
        F.col("l_shipdate").cast("date").alias("return_date"),
        reason.alias("return_reason"),
        (_cents("l_extendedprice") * kept_share).alias("refund_amount"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
    )


def from_star(spark: SparkSession, folder: str) -> RawTables:
    """The five raw relations read from a customer/part/orders/lineitem star schema.

    Lines flagged as returned supply the returns; the order status letter supplies the
    status; order and ship dates stand in for the load time.
    """

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return RawTables(
        line_key="string",
        users=lambda: _users(table("customer"), table("nation")),
        products=lambda: _products(table("part")),
        orders=lambda: _orders(table("orders")),
        order_items=lambda: _order_items(table("lineitem")),
        returns=lambda: _returns(table("lineitem")),
    )
