"""The declared checks of every relation, evaluated in one pass per table.

A pass writes the key columns that uniqueness and references need, and counts what breaks the
row rules on the way.  The rest works on those narrow keys, grouped once.  ``run_checks``
returns one row per check.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import match_key
from ..operators import checks as c
from ..session import stash

# Accepted values, ranges and freshness limits (days) of the relations.
STATUSES = ["completed", "cancelled", "pending", "processing"]
SEGMENTS = ["PREMIUM", "STANDARD", "BASIC"]
REASONS = ["defective", "changed_mind", "wrong_item", "damaged_shipping"]
TIERS = ["VIP", "GROWTH", "NEW", "PROSPECT"]
BANDS = ["LOYAL", "ACTIVE", "NEW", "INACTIVE"]
FRESHNESS = {
    "users": (7, 14),
    "products": (30, 60),
    "orders": (3, 7),
    "order_items": (3, 7),
    "returns": (7, 14),
}


@dataclass(frozen=True)
class RowRule:
    """A rule a single row can break; ``broken`` holds for a violating row."""

    check: str
    column: str
    broken: Column


@dataclass(frozen=True)
class Unique:
    columns: Sequence[str]


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


def not_null(*columns: str) -> list[RowRule]:
    return [RowRule("not_null", col, F.col(col).isNull()) for col in columns]


def accepted(column: str, values: Sequence[str]) -> RowRule:
    return RowRule("accepted_values", column, ~F.col(column).isin(list(values)))


def in_range(column: str, low=None, high=None, inclusive: bool = True) -> RowRule:
    return RowRule("accepted_range", column, c.out_of_range(column, low, high, inclusive))


def amounts_agree(column: str, expected: str) -> RowRule:
    off = F.abs(F.col(column) - F.expr(expected))
    return RowRule("expression", column, off > c.TOLERANCE)


def declared_rules(segments: Sequence[str] = SEGMENTS) -> dict[str, list]:
    """The checks of each relation.  Call with a live session: rules hold columns."""
    return {
        "raw_users": not_null("user_id", "email"),
        "raw_products": not_null("product_id"),
        "raw_orders": not_null("order_id", "order_date"),
        "raw_order_items": not_null("order_item_id"),
        "raw_returns": not_null("return_id"),
        "stg_users": [
            Unique(["user_id"]),
            *not_null("user_id", "email"),
            accepted("customer_segment", segments),
        ],
        "stg_products": [
            Unique(["product_id"]),
            *not_null("product_id", "product_name", "unit_cost"),
            in_range("unit_cost", low=0),
        ],
        "stg_orders": [
            Unique(["order_id"]),
            *not_null("order_id", "user_id", "order_date"),
            Reference("user_id", "stg_users", "user_id"),
            accepted("status", STATUSES),
        ],
        "stg_order_items": [
            Unique(["order_item_id"]),
            *not_null("order_item_id", "order_id", "product_id"),
            *not_null("quantity", "unit_price", "gross_item_sales"),
            Reference("order_id", "stg_orders", "order_id"),
            Reference("product_id", "stg_products", "product_id"),
            in_range("quantity", low=1),
            in_range("unit_price", low=0),
            amounts_agree("gross_item_sales", "quantity * unit_price"),
        ],
        "stg_returns": [
            Unique(["return_id"]),
            *not_null("return_id", "order_item_id", "return_date"),
            *not_null("return_reason", "refund_amount"),
            Reference("order_item_id", "stg_order_items", "order_item_id"),
            accepted("return_reason", REASONS),
            in_range("refund_amount", low=0),
        ],
        "order_metrics": [
            Unique(["order_id"]),
            *not_null("order_id", "user_id"),
            amounts_agree("net_sales", "gross_item_sales - total_refund_amount"),
        ],
        "customer_lifetime": [Unique(["user_id"]), *not_null("user_id")],
        "product_performance": [Unique(["product_id"]), *not_null("product_id")],
        "fct_orders": [
            Unique(["order_id"]),
            *not_null("order_id", "customer_id"),
            Reference("customer_id", "dim_customers", "customer_id"),
        ],
        "dim_customers": [
            Unique(["customer_id"]),
            *not_null("customer_id"),
            accepted("loyalty_tier", TIERS),
            accepted("engagement_band", BANDS),
        ],
        "mart_product_performance": [
            Unique(["product_id"]),
            *not_null("product_id"),
            in_range("return_rate", low=0, high=1),
            in_range("profit_margin_after_returns", low=-1, high=1),
        ],
        "segment_performance": [
            Unique(["customer_segment", "loyalty_tier"]),
            *not_null("customer_segment", "loyalty_tier"),
            in_range("active_customer_ratio", low=0, high=1),
        ],
        "daily_revenue_summary": [
            Unique(["daily_revenue_key"]),
            *not_null("revenue_date"),
            in_range("order_count", low=0),
        ],
        "unified_transactions": [
            *not_null("transaction_id", "transaction_date"),
            accepted("transaction_type", ["order", "return"]),
        ],
    }


RESULT = "table_name string, check_name string, column_name string, violations long"


def _row_rules(rules: Sequence) -> list[RowRule]:
    return [r for r in rules if isinstance(r, RowRule)]


class _Passes:
    """One pass per table: observed row rules, and the stored key columns."""

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        rules: Mapping[str, Sequence],
        through: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]],
    ):
        self.tables, self.rules, self.through = tables, rules, through
        self.names = [n for n in tables if n in rules]
        self.observed: list[tuple[str, list[RowRule], Observation]] = []
        self.columns: dict[str, list[str]] = {n: [] for n in self.names}
        for name in self.names:
            for rule in rules[name]:
                if isinstance(rule, Unique):
                    self.columns[name] += rule.columns
                elif isinstance(rule, Reference):
                    self.columns[name].append(rule.column)
                    self.columns.setdefault(rule.parent, []).append(rule.parent_column)
        inner = {base for base, _ in through.values()}
        self.keys: dict[str, DataFrame] = {}
        for name in dict.fromkeys([*self.names, *self.columns]):
            if name not in inner:
                self._run(name)

    def _observe(self, name: str, df: DataFrame) -> DataFrame:
        found = _row_rules(self.rules.get(name, ()))
        if not found:
            return df
        counts = Observation(f"checks of {name}")
        self.observed.append((name, found, counts))
        return df.observe(counts, *[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(found)])

    def _key(self, name: str, df: DataFrame, column: str) -> Column:
        """The column as it is grouped and joined: short, unless it is compared with another type."""
        kind = df.schema[column].dataType
        compared = [
            self.tables[other].schema[col].dataType
            for child in self.names
            for r in self.rules[child]
            if isinstance(r, Reference)
            for other, col, end in (
                (r.parent, r.parent_column, (child, r.column)),
                (child, r.column, (r.parent, r.parent_column)),
            )
            if end == (name, column)
        ]
        return match_key(F.col(column), kind) if all(k == kind for k in compared) else F.col(column)

    def _run(self, name: str) -> None:
        if name in self.through:
            base, derive = self.through[name]
            df = derive(self._observe(base, self.tables[base]))
        else:
            df = self.tables[name]
        columns = dict.fromkeys(self.columns.get(name, ()))
        kept = self._observe(name, df).select(*[self._key(name, df, c).alias(c) for c in columns])
        if columns:
            self.keys[name] = stash(kept, "checked-keys")
        elif _row_rules(self.rules.get(name, ())):
            kept.write.format("noop").mode("overwrite").save()

    def row_rule_results(self) -> list[tuple[str, str, str, int]]:
        return [
            (name, rule.check, rule.column, counts.get[f"r{i}"])
            for name, found, counts in self.observed
            for i, rule in enumerate(found)
        ]


def _one(violating: DataFrame, table: str, check: str, column: str) -> DataFrame:
    return violating.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        F.coalesce("violations", F.lit(0)).cast("long").alias("violations"),
    )


def run_checks(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Sequence] | None = None,
    through: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]] | None = None,
) -> DataFrame:
    """(table_name, check_name, column_name, violations, status) for the given tables.

    Each table is read once; its row rules are observed while its key columns are stored.
    ``through`` names tables that are derived from others, (table, function): both are then checked
    in the pass over the other.  The keys of a table are grouped once, for its uniqueness and as the
    parent set of references, and references are counted per key, so a hot key is one row.
    """
    rules = declared_rules() if rules is None else rules
    passes = _Passes(tables, rules, through or {})
    grouped: dict[tuple[str, ...], DataFrame] = {}

    def keys_of(table: str, columns: Sequence[str]) -> DataFrame:
        key = (table, *columns)
        if key not in grouped:
            counted = passes.keys[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
            grouped[key] = stash(counted, "checked-groups")
        return grouped[key]

    parts = [tables[passes.names[0]].sparkSession.createDataFrame(passes.row_rule_results(), RESULT)]
    for name in passes.names:
        for rule in rules[name]:
            if isinstance(rule, Unique):
                found = keys_of(name, rule.columns)
                if len(rule.columns) == 1:
                    found = found.where(F.col(rule.columns[0]).isNotNull())
                dupes = found.agg(F.count_if(F.col("n") > 1).alias("violations"))
                parts.append(_one(dupes, name, "unique", ",".join(rule.columns)))
            elif isinstance(rule, Reference):
                own, known = keys_of(name, [rule.column]), keys_of(rule.parent, [rule.parent_column])
                lost = c.check_relationship(own, rule.column, known, rule.parent_column)
                parts.append(_one(lost.agg(F.sum("n").alias("violations")), name, "relationships", rule.column))
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("violations") == 0, "pass").otherwise("fail")
    )


def freshness_report(
    sources: Mapping[str, DataFrame], as_of: dt.date | str, col: str = "ingested_at"
) -> DataFrame:
    """Freshness of each source against its limits."""
    rows = [
        c.check_freshness(df, col, *FRESHNESS[name], as_of=as_of, name=name)
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, rows)
