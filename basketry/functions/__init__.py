from .columns import (
    MONEY,
    engagement_band,
    growth_status,
    loyalty_tier,
    match_key,
    mean_of,
    opportunity_tier,
    pareto_class,
    percent_change,
    percent_of,
    return_risk,
    safe_divide,
    surrogate_key,
)
from .dates import (
    date_bounds,
    date_spine,
    days_between,
    month_start,
    parse_date,
    recent_months,
    spine_over,
    subtract_days,
    week_start,
)

__all__ = [
    "MONEY",
    "date_bounds",
    "date_spine",
    "days_between",
    "engagement_band",
    "growth_status",
    "loyalty_tier",
    "match_key",
    "mean_of",
    "month_start",
    "opportunity_tier",
    "pareto_class",
    "parse_date",
    "percent_change",
    "percent_of",
    "recent_months",
    "return_risk",
    "safe_divide",
    "spine_over",
    "subtract_days",
    "surrogate_key",
    "week_start",
]
