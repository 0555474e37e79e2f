"""All models over one set of raw tables, and the job that stores them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame

from ..functions import month_start
from ..functions.columns import GROWTH_REVENUE, VIP_REVENUE
from ..session import stash
from ..sources import RawTables, write_table
from . import daily, insight, marts, metrics
from .staging import stage_all


class Warehouse:
    """Builds each model from the raw tables on first use.

    Staging stays lazy.  The order metrics and the customer dimension feed several models,
    so they pass through ``keep``, which stores a frame and reads it back.
    """

    def __init__(
        self,
        raw: RawTables,
        vip: float = VIP_REVENUE,
        growth: float = GROWTH_REVENUE,
        keep: Callable[[DataFrame, str], DataFrame] = stash,
    ):
        self.raw = raw
        self.staged = stage_all(raw)
        self.vip, self.growth = vip, growth
        self.keep = keep

    @cached_property
    def order_products(self) -> DataFrame:
        """Order x product rows, which orders, facts and products are summed from."""
        s = self.staged
        returned = self.__dict__.get("returned_lines")  # one pass over the returns needs no stored lines
        return self.keep(metrics.order_product_rollup(s.order_items, s.returns, returned), "order-products")

    def match_returns(self, some: Column | None = None) -> DataFrame:
        """Find the lines of the returns once for all models, and store them.

        Returns that later count alone are named by the condition ``some``; without one the rows keep
        their ``line_key``.
        """
        s = self.staged
        found = metrics.returned_lines(s.order_items, s.returns, some)
        self.returned_lines = self.keep(found if some is None else found.drop("line_key"), "returned-lines")
        return self.returned_lines

    def fresh_order_metrics(self) -> DataFrame:
        s = self.staged
        stored = self.__dict__.get("order_products")  # one model alone needs no stored rollup
        return metrics.order_metrics(s.orders, s.order_items, s.returns, stored)

    def fresh_customer_lifetime(self) -> DataFrame:
        stored = self.__dict__.get("order_metrics")  # this model alone needs no stored metrics
        return metrics.customer_lifetime(self.staged.users, self.fresh_order_metrics() if stored is None else stored)

    @cached_property
    def order_metrics(self) -> DataFrame:
        # an md5 does not compress, so it is made again where it is read
        stored = self.keep(self.fresh_order_metrics().drop("order_surrogate_key"), "order-metrics")
        return metrics.with_order_key(stored)

    @cached_property
    def dim_customers(self) -> DataFrame:
        dim = marts.dim_customers(self.fresh_customer_lifetime(), self.vip, self.growth)
        return self.keep(dim, "dim-customers")

    @property
    def product_performance(self) -> DataFrame:
        s = self.staged
        stored = self.__dict__.get("order_products")
        return metrics.product_performance(s.products, s.order_items, s.orders, s.returns, stored)

    @property
    def fct_orders(self) -> DataFrame:
        sold = self.order_products  # first, so that the metrics are summed from it
        return marts.fct_orders(self.order_metrics, self.dim_customers, sold, self.staged.products)

    @property
    def order_headers(self) -> DataFrame:
        """The columns of the order facts that need no dimension."""
        return self.order_metrics.withColumnRenamed("user_id", "customer_id")

    @property
    def unified_transactions(self) -> DataFrame:
        s = self.staged
        return marts.unified_transactions(self.order_headers, s.returns, s.order_items)

    @property
    def enriched_orders(self) -> DataFrame:
        return insight.enrich_orders(self.fct_orders, self.dim_customers)


def build_warehouse(
    raw: RawTables,
    out: str,
    as_of: dt.date | str | None = None,
    vip: float = VIP_REVENUE,
    growth: float = GROWTH_REVENUE,
) -> dict[str, DataFrame]:
    """Rebuild every stored table under ``out`` and return the tables.

    Each table is laid out by the columns it is usually filtered on; its key comes last, so a
    large segment, category or day is spread over files.  Later tables read the stored
    copies of earlier ones.
    """
    wh = Warehouse(raw, vip, growth)
    s = wh.staged
    stored: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame, **layout) -> DataFrame:
        stored[name] = write_table(df, f"{out}/{name}", **layout)
        return stored[name]

    _ = wh.order_products  # lines are read once for all that follows
    wh.order_metrics = store(
        "order_metrics", wh.fresh_order_metrics(), sort_by=["order_date", "user_id", "order_id"]
    )
    lifetime = store(
        "customer_lifetime", wh.fresh_customer_lifetime(), sort_by=["customer_segment", "user_id"]
    )
    wh.dim_customers = store(
        "dim_customers",
        marts.dim_customers(lifetime, vip, growth),
        sort_by=["customer_segment", "loyalty_tier", "customer_id"],
    )
    by_category = ["category", "product_id"]
    performance = store("product_performance", wh.product_performance, sort_by=by_category)
    store("dim_products", marts.dim_products(s.products, performance), sort_by=by_category)
    store(
        "mart_product_performance",
        marts.mart_product_performance(performance),
        sort_by=by_category,
    )
    store("segment_performance", marts.segment_performance(wh.dim_customers))
    facts = store(
        "fct_orders",
        wh.fct_orders.withColumn("order_month", month_start("order_date")),
        partition_by="order_month",
        sort_by=["order_id"],
        cluster_by=["order_date", "customer_id"],
    )
    store("daily_revenue_summary", daily.daily_revenue_summary(facts), sort_by=["revenue_date"])
    store(
        "unified_transactions",
        marts.unified_transactions(facts, s.returns, s.order_items),
        sort_by=["transaction_date", "transaction_id"],
    )
    if as_of is not None:
        store(
            "segment_product_analysis",
            insight.segment_product_analysis(facts, wh.dim_customers, as_of),
        )
    return stored
