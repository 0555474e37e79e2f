"""Column-level helpers.  All of them are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(28, 6)

# Labels, thresholds and the key placeholder that stored results rely on.
VIP_REVENUE = 500
GROWTH_REVENUE = 200
LOYAL_ORDERS = 5
ACTIVE_ORDERS = 2
RAPID_GROWTH_PCT = 10
PARETO_PCT = 80
HIGH_RETURN_PCT = 15
MODERATE_RETURN_PCT = 5
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _double(value: Column | str) -> Column:
    return _col(value).cast("double")


def safe_divide(
    numerator: Column | str,
    denominator: Column | str,
    default: float | None = 0.0,
    as_percentage: bool = False,
) -> Column:
    """Ratio as DOUBLE; ``default`` (or NULL) where the denominator is 0 or NULL."""
    den = _double(denominator)
    ratio = _double(numerator) / den
    if as_percentage:
        ratio = ratio * 100.0
    fallback = F.lit(default).cast("double")
    return F.when(den.isNull() | (den == 0.0), fallback).otherwise(ratio)


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole, and 0 unless ``whole`` is positive."""
    base = _double(whole)
    return F.when(base > 0, _double(part) / base * 100.0).otherwise(F.lit(0.0))


def percent_change(current: Column | str, previous: Column | str) -> Column:
    """Growth in percent; NULL unless the previous value is positive."""
    before = _col(previous)
    change = (_col(current) - before).cast("double")
    return F.when(before > 0, change / before.cast("double") * 100.0)


def mean_of(value: Column | str) -> Column:
    """Average as an aggregate whose sum is exact: sum as decimal, divide as DOUBLE."""
    c = _col(value)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def surrogate_key(*cols: Column | str, null_token: str = NULL_KEY_PART) -> Column:
    """md5 over the parts joined with '-'; a NULL part is replaced by a placeholder."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def match_key(key: Column, kind: T.DataType) -> Column:
    """A value that is equal for equal keys only, and shorter to shuffle where keys are md5 texts.

    A text of 32 lower-case hex digits becomes its 16 bytes; any other text becomes its UTF-8
    bytes behind 17 zero bytes, which no md5 equals.  Other types stay as they are.
    """
    if not isinstance(kind, T.StringType):
        return key
    other = F.concat(F.lit(bytes(17)), key.cast("binary"))
    return F.when(key.rlike("^[0-9a-f]{32}\\z"), F.unhex(key)).otherwise(other)


def loyalty_tier(
    revenue: Column | str, vip: float = VIP_REVENUE, growth: float = GROWTH_REVENUE
) -> Column:
    r = _col(revenue)
    return (
        F.when(r >= vip, F.lit("VIP"))
        .when(r >= growth, F.lit("GROWTH"))
        .when(r > 0, F.lit("NEW"))
        .otherwise(F.lit("PROSPECT"))
    )


def engagement_band(orders: Column | str) -> Column:
    n = _col(orders)
    return (
        F.when(n >= LOYAL_ORDERS, F.lit("LOYAL"))
        .when(n.between(ACTIVE_ORDERS, LOYAL_ORDERS - 1), F.lit("ACTIVE"))
        .when(n == 1, F.lit("NEW"))
        .otherwise(F.lit("INACTIVE"))
    )


def growth_status(pct: Column | str) -> Column:
    p = _col(pct)
    return (
        F.when(p > RAPID_GROWTH_PCT, F.lit("Rapid Growth"))
        .when(p > 0, F.lit("Growing"))
        .when(p < -RAPID_GROWTH_PCT, F.lit("Declining"))
        .otherwise(F.lit("Stable"))
    )


def pareto_class(cumulative_pct: Column | str) -> Column:
    inside = _col(cumulative_pct) <= PARETO_PCT
    return F.when(inside, F.lit("Top 80% Product")).otherwise(F.lit("Long Tail Product"))


def return_risk(pct: Column | str) -> Column:
    p = _col(pct)
    return (
        F.when(p > HIGH_RETURN_PCT, F.lit("High Return Risk"))
        .when(p > MODERATE_RETURN_PCT, F.lit("Moderate Return Risk"))
        .otherwise(F.lit("Low Return Risk"))
    )


def opportunity_tier(customers: Column | str, mean_order: Column | str) -> Column:
    """Label by number of VIP buyers and their mean order: (3, 100) high, (2, 50) medium."""
    n, mean = _col(customers), _col(mean_order)
    return (
        F.when((n >= 3) & (mean >= 100), F.lit("High Opportunity"))
        .when((n >= 2) & (mean >= 50), F.lit("Medium Opportunity"))
        .otherwise(F.lit("Low Opportunity"))
    )
