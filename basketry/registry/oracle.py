"""Independent SQL for each registered query, run by DuckDB on the same tables.

``RELATIONS`` holds named sub-queries.  ``ask`` puts the ones a statement mentions (and
the ones those mention) into its WITH clause.
"""

from __future__ import annotations

import re

NULL_PART = "_dbt_utils_surrogate_key_null_"


def key(*parts: str) -> str:
    texts = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULL_PART}')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def ratio(num: str, den: str, default: str = "0") -> str:
    return (
        f"CASE WHEN {den} IS NULL OR {den} = 0 THEN CAST({default} AS DOUBLE) "
        f"ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"
    )


def mean(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) / nullif(CAST(count({col}) AS DOUBLE), 0)"


def pct(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100.0 "
        "ELSE 0.0 END"
    )


def interpolated(p: str) -> str:
    """Continuous percentile from row places, in plain DOUBLE arithmetic.

    ``quantile_cont`` gives the same number up to its last bit, which a value hash sees.
    """
    spot = f"(CAST({p} AS DOUBLE) * (n - 1))"
    low = f"max(v) FILTER (WHERE place = floor({spot}) + 1)"
    high = f"max(v) FILTER (WHERE place = ceil({spot}) + 1)"
    part = f"max({spot} - floor({spot}))"
    return f"{low} * (CAST(1 AS DOUBLE) - {part}) + {high} * {part}"


def discrete(p: str) -> str:
    return f"max(v) FILTER (WHERE place = greatest(ceil(CAST({p} AS DOUBLE) * n), 1))"


SERIES = "customer_segment, loyalty_tier, primary_product_category"
LINE_ID = key(
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    "CAST(l_extendedprice AS DECIMAL(18,2))", "CAST(l_shipdate AS DATE)",
)

RELATIONS = {
    "s_users": """
        SELECT c.c_custkey AS user_id, lower(c.c_name || '@example.com') AS email,
               CAST(NULL AS DATE) AS signup_date, upper(n.n_name) AS country,
               upper(c.c_mktsegment) AS customer_segment, CAST(NULL AS DATE) AS ingested_at
        FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "s_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, upper(p_type) AS category,
               CAST(NULL AS BIGINT) AS supplier_id,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(28,6)) AS unit_cost,
               CAST(NULL AS DATE) AS ingested_at
        FROM part""",
    "s_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing'
                    WHEN 'P' THEN 'pending' ELSE lower(o_orderstatus) END AS status,
               coalesce(o_orderstatus = 'F', FALSE) AS is_completed,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(28,6)) AS total_amount,
               CAST(o_orderdate AS DATE) AS ingested_at
        FROM orders""",
    "priced": f"""
        SELECT {LINE_ID} AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(round(l_extendedprice * 100) AS BIGINT) * 10000 AS micros,
               CAST(l_shipdate AS DATE) AS ingested_at
        FROM lineitem""",
    "s_items": """
        SELECT order_item_id, order_id, product_id, quantity, unit_price,
               CAST(CAST(quantity AS DECIMAL(10,0)) * unit_price AS DECIMAL(28,6))
                   AS gross_item_sales,
               ingested_at
        FROM (SELECT *, CAST(CAST((2 * micros + quantity) // (2 * quantity) AS DECIMAL(18,0))
                             * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(28,6)) AS unit_price
              FROM priced)""",
    "s_returns": f"""
        SELECT {LINE_ID} AS return_id, {LINE_ID} AS order_item_id,
               CAST(l_shipdate AS DATE) AS return_date,
               CASE WHEN l_linestatus = 'O' THEN 'defective' ELSE 'changed_mind' END
                   AS return_reason,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(28,6)) AS refund_amount,
               CAST(l_shipdate AS DATE) AS ingested_at
        FROM lineitem WHERE l_returnflag = 'R'""",
    "sales_places": """
        SELECT CAST(gross_item_sales AS DOUBLE) AS v, row_number() OVER (ORDER BY gross_item_sales) AS place,
               count(*) OVER () AS n FROM s_items""",
    "quantity_places": """
        SELECT CAST(quantity AS DOUBLE) AS v, row_number() OVER (ORDER BY quantity) AS place,
               count(*) OVER () AS n FROM s_items""",
    "returned": """
        SELECT r.*, i.order_id, i.product_id, i.quantity
        FROM s_returns r, s_items i WHERE i.order_item_id = r.order_item_id""",
    "metrics": f"""
        SELECT o.order_id, o.user_id, o.order_date, o.status, o.is_completed,
               o.total_amount AS order_total_amount,
               coalesce(l.units, 0) AS total_item_quantity, coalesce(l.n, 0) AS line_item_count,
               coalesce(l.products, 0) AS distinct_products,
               coalesce(l.gross, 0) AS gross_item_sales,
               coalesce(b.refund, 0) AS total_refund_amount,
               coalesce(l.gross, 0) - coalesce(b.refund, 0) AS net_sales,
               coalesce(b.n, 0) AS return_count,
               {key("o.order_id", "o.user_id", "o.order_date")} AS order_surrogate_key
        FROM s_orders o
        LEFT JOIN (SELECT order_id, sum(quantity) AS units, count(*) AS n,
                          count(DISTINCT product_id) AS products, sum(gross_item_sales) AS gross
                   FROM s_items GROUP BY order_id) l ON l.order_id = o.order_id
        LEFT JOIN (SELECT order_id, count(return_id) AS n, sum(refund_amount) AS refund
                   FROM returned GROUP BY order_id) b ON b.order_id = o.order_id""",
    "lifetime": f"""
        SELECT u.user_id, u.email, u.signup_date, u.country, u.customer_segment,
               count(m.order_id) AS completed_order_count,
               coalesce(sum(m.net_sales), 0) AS lifetime_revenue,
               coalesce(sum(m.total_item_quantity), 0) AS lifetime_units,
               coalesce({mean("m.net_sales")}, 0) AS avg_order_value,
               min(m.order_date) AS first_order_date, max(m.order_date) AS most_recent_order_date,
               coalesce(sum(m.return_count), 0) AS total_return_count,
               coalesce(sum(m.total_refund_amount), 0) AS total_refunded_amount
        FROM s_users u LEFT JOIN metrics m ON m.user_id = u.user_id AND m.is_completed
        GROUP BY ALL""",
    "dim": """
        SELECT user_id AS customer_id, * EXCLUDE (user_id),
               CASE WHEN lifetime_revenue >= 900000 THEN 'VIP'
                    WHEN lifetime_revenue >= 400000 THEN 'GROWTH'
                    WHEN lifetime_revenue > 0 THEN 'NEW' ELSE 'PROSPECT' END AS loyalty_tier,
               CASE WHEN completed_order_count >= 5 THEN 'LOYAL'
                    WHEN completed_order_count >= 2 THEN 'ACTIVE'
                    WHEN completed_order_count = 1 THEN 'NEW' ELSE 'INACTIVE' END
                   AS engagement_band,
               completed_order_count > 0 AS is_active_customer
        FROM lifetime""",
    "segments": f"""
        SELECT *, {ratio("active_customer_count", "customer_count")} AS active_customer_ratio,
               {ratio("total_segment_refunds", "total_segment_revenue")}
                   AS refund_to_revenue_ratio
        FROM (SELECT customer_segment, loyalty_tier, count(*) AS customer_count,
                     count(*) FILTER (WHERE is_active_customer) AS active_customer_count,
                     {mean("lifetime_revenue")} AS avg_lifetime_revenue,
                     sum(lifetime_revenue) AS total_segment_revenue,
                     {mean("completed_order_count")} AS avg_completed_orders,
                     sum(total_refunded_amount) AS total_segment_refunds,
                     {mean("total_return_count")} AS avg_returns_per_customer
              FROM dim GROUP BY customer_segment, loyalty_tier)""",
    "done_items": """
        SELECT i.* FROM s_items i
        WHERE i.order_id IN (SELECT order_id FROM s_orders WHERE is_completed)""",
    "products_perf": f"""
        SELECT *, gross_sales - total_refund_amount AS net_sales_after_returns,
               unit_cost * total_units_sold AS estimated_cogs,
               gross_sales - unit_cost * total_units_sold AS gross_profit_before_returns,
               gross_sales - total_refund_amount - unit_cost * total_units_sold
                   AS gross_profit_after_returns,
               {ratio("gross_sales", "total_units_sold", "NULL")} AS avg_unit_price_realized
        FROM (SELECT p.product_id, p.product_name, p.category, p.supplier_id, p.unit_cost,
                     coalesce(s.n, 0) AS orders_sold,
                     CAST(coalesce(s.units, 0) AS BIGINT) AS total_units_sold,
                     coalesce(s.gross, 0) AS gross_sales, coalesce(b.n, 0) AS return_count,
                     coalesce(b.units, 0) AS units_returned,
                     coalesce(b.refund, 0) AS total_refund_amount
              FROM s_products p
              LEFT JOIN (SELECT product_id, count(DISTINCT order_id) AS n,
                                sum(quantity) AS units, sum(gross_item_sales) AS gross
                         FROM done_items GROUP BY product_id) s ON s.product_id = p.product_id
              LEFT JOIN (SELECT product_id, count(return_id) AS n, sum(quantity) AS units,
                                sum(refund_amount) AS refund
                         FROM returned GROUP BY product_id) b ON b.product_id = p.product_id)""",
    "rated": f"""
        SELECT *, {ratio("units_returned", "total_units_sold")} AS return_rate,
               {ratio("gross_profit_after_returns", "gross_sales")}
                   AS profit_margin_after_returns,
               {ratio("gross_profit_after_returns", "estimated_cogs", "NULL")}
                   AS roi_after_returns
        FROM products_perf""",
    "ledger": """
        SELECT CAST(order_id AS VARCHAR) AS transaction_id, order_date AS transaction_date,
               user_id AS customer_id, 'order' AS transaction_type,
               net_sales AS transaction_amount
        FROM metrics WHERE is_completed
        UNION ALL
        SELECT r.return_id, r.return_date, o.user_id, 'return', -r.refund_amount
        FROM returned r JOIN s_orders o ON o.order_id = r.order_id""",
    "sold": """
        SELECT i.order_id, p.product_id, p.product_name, p.category,
               sum(i.quantity) AS units, sum(i.gross_item_sales) AS sales
        FROM s_items i, s_products p WHERE p.product_id = i.product_id GROUP BY ALL""",
    "main_product": """
        SELECT order_id, product_id AS primary_product_id, product_name AS primary_product_name,
               category AS primary_product_category, units AS primary_product_quantity,
               sales AS primary_product_sales
        FROM sold
        QUALIFY row_number() OVER (PARTITION BY order_id
                                   ORDER BY units DESC, sales DESC, product_id) = 1""",
    "mix": """
        SELECT order_id, count(DISTINCT category) AS distinct_categories
        FROM sold GROUP BY order_id""",
    "facts": """
        SELECT m.order_id, m.user_id AS customer_id, d.email AS customer_email,
               d.country AS customer_country, d.customer_segment, d.loyalty_tier, m.order_date,
               m.status, m.is_completed, m.order_total_amount, m.total_item_quantity,
               m.line_item_count, m.distinct_products, x.distinct_categories,
               m.gross_item_sales, m.total_refund_amount, m.net_sales, m.return_count,
               t.* EXCLUDE (order_id), d.lifetime_revenue AS customer_lifetime_revenue,
               d.completed_order_count AS customer_completed_order_count,
               d.first_order_date AS customer_first_order_date,
               d.most_recent_order_date AS customer_most_recent_order_date
        FROM metrics m
        LEFT JOIN dim d ON d.customer_id = m.user_id
        LEFT JOIN main_product t ON t.order_id = m.order_id
        LEFT JOIN mix x ON x.order_id = m.order_id""",
    "per_day": f"""
        SELECT order_date, {SERIES}, count(DISTINCT order_id) AS order_count,
               count(DISTINCT customer_id) AS unique_customers,
               sum(net_sales) AS total_revenue, sum(gross_item_sales) AS total_gross_sales,
               sum(total_refund_amount) AS total_refunds, {mean("net_sales")} AS avg_order_value,
               sum(total_item_quantity) AS total_units_sold
        FROM facts WHERE is_completed GROUP BY order_date, {SERIES}""",
    "all_days": """
        SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY))
                    AS DATE) AS revenue_date
        FROM per_day""",
    "filled": f"""
        SELECT a.revenue_date, {SERIES},
               {key("a.revenue_date", "customer_segment", "loyalty_tier",
                    "primary_product_category")} AS daily_revenue_key,
               coalesce(order_count, 0) AS order_count,
               coalesce(unique_customers, 0) AS unique_customers,
               coalesce(total_units_sold, 0) AS total_units_sold,
               coalesce(total_revenue, 0) AS total_revenue,
               coalesce(total_gross_sales, 0) AS total_gross_sales,
               coalesce(total_refunds, 0) AS total_refunds, avg_order_value
        FROM all_days a LEFT JOIN per_day p ON p.order_date = a.revenue_date""",
    "dense": f"""
        SELECT a.revenue_date, s.customer_segment, s.loyalty_tier, s.primary_product_category,
               {key("a.revenue_date", "s.customer_segment", "s.loyalty_tier",
                    "s.primary_product_category")} AS daily_revenue_key,
               coalesce(order_count, 0) AS order_count,
               coalesce(unique_customers, 0) AS unique_customers,
               coalesce(total_units_sold, 0) AS total_units_sold,
               coalesce(total_revenue, 0) AS total_revenue,
               coalesce(total_gross_sales, 0) AS total_gross_sales,
               coalesce(total_refunds, 0) AS total_refunds, avg_order_value
        FROM all_days a CROSS JOIN (SELECT DISTINCT {SERIES} FROM per_day) s
        LEFT JOIN per_day p ON p.order_date = a.revenue_date
             AND p.customer_segment IS NOT DISTINCT FROM s.customer_segment
             AND p.loyalty_tier IS NOT DISTINCT FROM s.loyalty_tier
             AND p.primary_product_category IS NOT DISTINCT FROM s.primary_product_category""",
    "enriched": """
        SELECT f.order_id, f.order_date, f.customer_id, f.customer_segment, f.loyalty_tier,
               f.customer_country, f.primary_product_id, f.primary_product_name,
               f.primary_product_category, f.net_sales, f.gross_item_sales,
               f.total_refund_amount, f.return_count, f.total_item_quantity,
               f.distinct_products, d.lifetime_revenue AS customer_lifetime_revenue,
               d.completed_order_count AS customer_total_orders,
               d.avg_order_value AS customer_avg_order_value, d.engagement_band
        FROM facts f, dim d WHERE d.customer_id = f.customer_id AND f.is_completed""",
    "monthly": f"""
        SELECT *,
               sum(total_net_sales) OVER (in_order ROWS UNBOUNDED PRECEDING)
                   AS segment_running_total_revenue,
               lag(total_net_sales) OVER in_order AS previous_month_revenue
        FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, {SERIES},
                     count(DISTINCT order_id) AS order_count,
                     count(DISTINCT customer_id) AS unique_customers,
                     sum(net_sales) AS total_net_sales,
                     sum(gross_item_sales) AS total_gross_sales,
                     sum(total_refund_amount) AS total_refunds,
                     sum(return_count) AS total_returns,
                     sum(total_item_quantity) AS total_units_sold,
                     {mean("net_sales")} AS avg_order_value
              FROM enriched GROUP BY ALL)
        WINDOW in_order AS (PARTITION BY customer_segment
                            ORDER BY order_month NULLS FIRST, loyalty_tier NULLS FIRST,
                                     primary_product_category NULLS FIRST)""",
    "trends": f"""
        SELECT *,
               CASE WHEN previous_month_revenue > 0
                    THEN CAST(total_net_sales - previous_month_revenue AS DOUBLE)
                         / CAST(previous_month_revenue AS DOUBLE) * 100.0
               END AS mom_growth_rate_pct,
               {pct("total_returns", "total_units_sold")} AS return_rate_pct,
               {pct("total_refunds", "total_gross_sales")} AS refund_rate_pct
        FROM monthly""",
    "ranked_products": f"""
        SELECT *,
               rank() OVER (PARTITION BY customer_segment, primary_product_category
                            ORDER BY total_revenue DESC) AS revenue_rank_in_category,
               CAST(total_revenue AS DOUBLE) * 100.0
                   / CAST(sum(total_revenue) OVER (PARTITION BY customer_segment) AS DOUBLE)
                   AS pct_of_segment_revenue,
               CAST(sum(total_revenue) OVER (
                        PARTITION BY customer_segment
                        ORDER BY total_revenue DESC, loyalty_tier NULLS FIRST,
                                 primary_product_category NULLS FIRST, primary_product_id
                        ROWS UNBOUNDED PRECEDING) AS DOUBLE) * 100.0
                   / CAST(sum(total_revenue) OVER (PARTITION BY customer_segment) AS DOUBLE)
                   AS cumulative_revenue_pct
        FROM (SELECT {SERIES}, primary_product_id, primary_product_name,
                     count(DISTINCT order_id) AS order_count,
                     count(DISTINCT customer_id) AS unique_customers,
                     sum(net_sales) AS total_revenue, sum(total_item_quantity) AS total_units,
                     {mean("net_sales")} AS avg_order_value, sum(return_count) AS total_returns
              FROM enriched WHERE primary_product_id IS NOT NULL GROUP BY ALL)""",
    "ltv": f"""
        SELECT *, date_diff('day', first_order_date, last_order_date) AS customer_tenure_days,
               rank() OVER (PARTITION BY customer_segment, primary_product_category
                            ORDER BY category_lifetime_value DESC)
                   AS ltv_rank_in_segment_category
        FROM (SELECT customer_id, {SERIES}, count(DISTINCT order_id) AS orders_in_category,
                     sum(net_sales) AS category_lifetime_value,
                     max(order_date) AS last_order_date, min(order_date) AS first_order_date
              FROM enriched WHERE primary_product_category IS NOT NULL GROUP BY ALL)""",
    "ltv_placed": """
        SELECT *, CAST(category_lifetime_value AS DOUBLE) AS v,
               row_number() OVER (PARTITION BY customer_segment, primary_product_category
                                  ORDER BY category_lifetime_value) AS place,
               count(*) OVER (PARTITION BY customer_segment, primary_product_category) AS n
        FROM ltv""",
    "ltv_stats": f"""
        SELECT customer_segment, primary_product_category,
               count(DISTINCT customer_id) AS total_customers,
               {mean("category_lifetime_value")} AS avg_category_ltv,
               {interpolated("0.5")} AS median_category_ltv,
               {interpolated("0.75")} AS p75_category_ltv,
               {interpolated("0.9")} AS p90_category_ltv,
               {interpolated("0.95")} AS p95_category_ltv,
               max(category_lifetime_value) AS max_category_ltv,
               {mean("orders_in_category")} AS avg_orders_per_customer,
               {mean("customer_tenure_days")} AS avg_tenure_days
        FROM ltv_placed GROUP BY customer_segment, primary_product_category""",
    "vip_demand": f"""
        SELECT *, CASE WHEN vip_customer_count >= 3 AND avg_vip_order_value >= 100
                       THEN 'High Opportunity'
                       WHEN vip_customer_count >= 2 AND avg_vip_order_value >= 50
                       THEN 'Medium Opportunity' ELSE 'Low Opportunity' END AS opportunity_tier
        FROM (SELECT {SERIES}, primary_product_id, primary_product_name,
                     count(DISTINCT customer_id) AS vip_customer_count,
                     sum(net_sales) AS revenue_from_vip, {mean("net_sales")} AS avg_vip_order_value
              FROM enriched WHERE loyalty_tier = 'VIP' AND primary_product_id IS NOT NULL
              GROUP BY ALL)""",
    "seen_costs": """
        SELECT i.product_id, CAST(date_trunc('month', o.order_date) AS DATE) AS seen_on,
               max(i.unit_price) AS unit_cost
        FROM s_items i JOIN s_orders o ON o.order_id = i.order_id GROUP BY ALL""",
}


def with_relations(sql: str) -> str:
    """Prefix the statement with every relation it needs, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(RELATIONS[name])

    visit(sql)
    parts = [f"{name} AS ({RELATIONS[name].strip()})" for name in RELATIONS if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


CASTS = {"$": "DOUBLE", "#": "BIGINT", "@": "DATE"}


def ask(columns: str, rest: str) -> str:
    """SELECT the listed columns; a trailing mark casts: $ DOUBLE, # BIGINT, @ DATE."""
    names = []
    for item in columns.split():
        cast = CASTS.get(item[-1])
        names.append(f"CAST({item[:-1]} AS {cast}) AS {item[:-1]}" if cast else item)
    return with_relations(f"SELECT {', '.join(names)} {rest}")


USERS = "user_id email signup_date@ country customer_segment ingested_at@"
ORDERS = "order_id user_id order_date@ status is_completed total_amount$"
ITEMS = "order_item_id order_id product_id quantity# unit_price$ gross_item_sales$"
RETURNS = "return_id order_item_id return_date@ return_reason refund_amount$"
METRICS = (
    "order_id user_id order_date@ status is_completed order_total_amount$ total_item_quantity# "
    "line_item_count# distinct_products# gross_item_sales$ total_refund_amount$ net_sales$ "
    "return_count# order_surrogate_key"
)
LIFETIME = (
    "email signup_date@ country customer_segment completed_order_count# lifetime_revenue$ "
    "lifetime_units# avg_order_value$ first_order_date@ most_recent_order_date@ "
    "total_return_count# total_refunded_amount$"
)
DIM = f"customer_id {LIFETIME} loyalty_tier engagement_band is_active_customer"
SEGMENTS = (
    "customer_segment loyalty_tier customer_count# active_customer_count# "
    "active_customer_ratio$ avg_lifetime_revenue$ total_segment_revenue$ avg_completed_orders$ "
    "total_segment_refunds$ avg_returns_per_customer$ refund_to_revenue_ratio$"
)
PERFORMANCE = (
    "product_id product_name category supplier_id# unit_cost$ orders_sold# total_units_sold# "
    "gross_sales$ avg_unit_price_realized$ return_count# units_returned# total_refund_amount$ "
    "net_sales_after_returns$ estimated_cogs$ gross_profit_before_returns$ "
    "gross_profit_after_returns$"
)
MAIN_PRODUCT = (
    "primary_product_id primary_product_name primary_product_category "
    "primary_product_quantity# primary_product_sales$"
)
FACTS = (
    "order_id customer_id customer_email customer_country customer_segment loyalty_tier "
    "order_date@ status is_completed order_total_amount$ total_item_quantity# "
    "line_item_count# distinct_products# distinct_categories# gross_item_sales$ "
    f"total_refund_amount$ net_sales$ return_count# {MAIN_PRODUCT} "
    "customer_lifetime_revenue$ customer_completed_order_count# customer_first_order_date@ "
    "customer_most_recent_order_date@"
)
DIMS = "customer_segment loyalty_tier primary_product_category"
DAY_MEASURES = (
    "order_count# unique_customers# total_units_sold# total_revenue$ total_gross_sales$ "
    "total_refunds$ avg_order_value$"
)
DAY_ROW = f"revenue_date@ {DIMS} daily_revenue_key {DAY_MEASURES}"
ENRICHED = (
    f"order_id order_date@ customer_id {DIMS} customer_country primary_product_id "
    "primary_product_name net_sales$ gross_item_sales$ total_refund_amount$ return_count# "
    "total_item_quantity# distinct_products# customer_lifetime_revenue$ "
    "customer_total_orders# customer_avg_order_value$ engagement_band"
)
MONTHLY = (
    f"order_month@ {DIMS} order_count# unique_customers# total_net_sales$ total_gross_sales$ "
    "total_refunds$ total_returns# total_units_sold# avg_order_value$ "
    "segment_running_total_revenue$ previous_month_revenue$"
)
RATES = "mom_growth_rate_pct$ return_rate_pct$ refund_rate_pct$"
RANKED = (
    f"{DIMS} primary_product_id primary_product_name order_count# unique_customers# "
    "total_revenue$ total_units# avg_order_value$ total_returns# revenue_rank_in_category# "
    "pct_of_segment_revenue$ cumulative_revenue_pct$"
)
KEPT_FACTS = (
    "order_id customer_id order_date@ status order_total_amount$ line_item_count# "
    "distinct_categories# gross_item_sales$ total_refund_amount$ net_sales$ return_count# "
    "primary_product_id primary_product_sales$"
)
EVENT_TOTALS = """
    SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS event_count,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
    FROM events GROUP BY ALL"""
GROWTH_LABEL = """CASE WHEN mom_growth_rate_pct > 10 THEN 'Rapid Growth'
    WHEN mom_growth_rate_pct > 0 THEN 'Growing'
    WHEN mom_growth_rate_pct < -10 THEN 'Declining' ELSE 'Stable' END"""


def loaded(columns: str, relation: str, good: str, key: str, reasons: str) -> str:
    """Staged rows of an extract whose records are ``good``, and the others with their reasons."""
    kept, lost = [], []
    for item in columns.split():
        name, cast = (item[:-1], CASTS.get(item[-1])) if item[-1] in CASTS else (item, None)
        kept.append(f"CAST({name} AS {cast}) AS {name}" if cast else name)
        lost.append("NULL")
    return with_relations(
        f""", outcomes AS (
          SELECT {", ".join(kept)}, 'loaded' AS outcome, CAST(NULL AS VARCHAR) AS record_key,
                 CAST(NULL AS VARCHAR) AS reasons FROM {relation} WHERE {good}
          UNION ALL
          SELECT {", ".join(lost)}, 'rejected', {key}, {reasons} FROM {relation} WHERE NOT ({good}))
        SELECT *, (SELECT count(*) FROM outcomes WHERE outcome = 'loaded') AS n_loaded,
               (SELECT count(*) FROM outcomes WHERE outcome = 'rejected') AS n_rejected
        FROM outcomes"""
    )


def summary(relation: str) -> str:
    return ask(
        f"{DAY_ROW} revenue_7day_avg$ revenue_30day_total$ days_since_segment_start#",
        f"""FROM (SELECT *,
            CAST(sum(total_revenue) OVER (series ROWS 6 PRECEDING) AS DOUBLE)
                / CAST(count(*) OVER (series ROWS 6 PRECEDING) AS DOUBLE) AS revenue_7day_avg,
            sum(total_revenue) OVER (series ROWS 29 PRECEDING) AS revenue_30day_total,
            date_diff('day', min(revenue_date) OVER (
                PARTITION BY customer_segment, loyalty_tier), revenue_date)
                AS days_since_segment_start
            FROM {relation}
            WINDOW series AS (PARTITION BY {SERIES} ORDER BY revenue_date))""",
    )


REPORT = f"""
    FROM (
      SELECT t.order_month, t.customer_segment, t.loyalty_tier, t.primary_product_category,
             t.total_net_sales, t.total_gross_sales, t.segment_running_total_revenue,
             t.mom_growth_rate_pct, t.order_count, t.unique_customers, t.avg_order_value,
             t.total_returns, t.return_rate_pct, t.refund_rate_pct, p.primary_product_id,
             p.primary_product_name, p.revenue_rank_in_category, p.pct_of_segment_revenue,
             p.cumulative_revenue_pct, l.avg_category_ltv, l.median_category_ltv,
             l.p90_category_ltv, l.avg_orders_per_customer, v.opportunity_tier,
             v.revenue_from_vip, v.vip_customer_count,
             {GROWTH_LABEL} AS growth_status,
             CASE WHEN p.cumulative_revenue_pct <= 80 THEN 'Top 80% Product'
                  ELSE 'Long Tail Product' END AS pareto_classification,
             CASE WHEN t.return_rate_pct > 15 THEN 'High Return Risk'
                  WHEN t.return_rate_pct > 5 THEN 'Moderate Return Risk'
                  ELSE 'Low Return Risk' END AS return_risk_level
      FROM trends t
      LEFT JOIN (SELECT * FROM ranked_products WHERE revenue_rank_in_category <= 5) p
             ON (p.customer_segment, p.loyalty_tier, p.primary_product_category)
              = (t.customer_segment, t.loyalty_tier, t.primary_product_category)
      LEFT JOIN ltv_stats l
             ON l.customer_segment = t.customer_segment
            AND l.primary_product_category = t.primary_product_category
      LEFT JOIN vip_demand v
             ON v.customer_segment = t.customer_segment AND v.loyalty_tier = t.loyalty_tier
            AND v.primary_product_category = t.primary_product_category
            AND v.primary_product_id = p.primary_product_id
      WHERE t.order_month >= DATE '2001-02-01')"""

UNIQUE_PARTS = {
    "stg_users": ("s_users", "user_id"),
    "stg_products": ("s_products", "product_id"),
    "stg_orders": ("s_orders", "order_id"),
    "stg_order_items": ("s_items", "order_item_id"),
    "stg_returns": ("s_returns", "return_id"),
    "order_metrics": ("metrics", "order_id"),
}
NOT_NULL_PARTS = {
    "stg_users": "user_id email",
    "stg_products": "product_id product_name unit_cost",
    "stg_orders": "order_id user_id order_date",
    "stg_order_items": "order_item_id order_id product_id quantity unit_price gross_item_sales",
    "stg_returns": "return_id order_item_id return_date return_reason refund_amount",
    "order_metrics": "order_id user_id",
}
ROW_PARTS = [
    ("stg_users", "accepted_values", "customer_segment",
     "customer_segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')"),
    ("stg_products", "accepted_range", "unit_cost", "unit_cost < 0"),
    ("stg_orders", "accepted_values", "status",
     "status NOT IN ('completed', 'cancelled', 'pending', 'processing')"),
    ("stg_order_items", "accepted_range", "quantity", "quantity < 1"),
    ("stg_order_items", "accepted_range", "unit_price", "unit_price < 0"),
    ("stg_order_items", "expression", "gross_item_sales",
     "abs(gross_item_sales - quantity * unit_price) > 0.01"),
    ("order_metrics", "expression", "net_sales",
     "abs(net_sales - (gross_item_sales - total_refund_amount)) > 0.01"),
    ("stg_returns", "accepted_values", "return_reason",
     "return_reason NOT IN ('defective', 'changed_mind', 'wrong_item', 'damaged_shipping')"),
    ("stg_returns", "accepted_range", "refund_amount", "refund_amount < 0"),
]
PARENT_PARTS = [
    ("stg_orders", "user_id", "s_users", "user_id"),
    ("stg_order_items", "order_id", "s_orders", "order_id"),
    ("stg_order_items", "product_id", "s_products", "product_id"),
    ("stg_returns", "order_item_id", "s_items", "order_item_id"),
]


RAW_PARTS = {
    "raw_users": ("s_users", "user_id email"),
    "raw_products": ("s_products", "product_id"),
    "raw_orders": ("s_orders", "order_id order_date"),
    "raw_order_items": ("s_items", "order_item_id"),
    "raw_returns": ("s_returns", "return_id"),
}
MART_PARTS = [
    ("customer_lifetime", "lifetime", "user_id", "user_id", []),
    ("product_performance", "products_perf", "product_id", "product_id", []),
    ("dim_customers", "dim", "customer_id", "customer_id", [
        ("accepted_values", "loyalty_tier",
         "loyalty_tier NOT IN ('VIP', 'GROWTH', 'NEW', 'PROSPECT')"),
        ("accepted_values", "engagement_band",
         "engagement_band NOT IN ('LOYAL', 'ACTIVE', 'NEW', 'INACTIVE')")]),
    ("fct_orders", "facts", "order_id", "order_id customer_id", [
        ("relationships", "customer_id",
         "customer_id NOT IN (SELECT customer_id FROM dim)")]),
    ("mart_product_performance", "rated", "product_id", "product_id", [
        ("accepted_range", "return_rate", "return_rate < 0 OR return_rate > 1"),
        ("accepted_range", "profit_margin_after_returns",
         "profit_margin_after_returns < -1 OR profit_margin_after_returns > 1")]),
    ("segment_performance", "segments", "customer_segment,loyalty_tier",
     "customer_segment loyalty_tier", [
        ("accepted_range", "active_customer_ratio",
         "active_customer_ratio < 0 OR active_customer_ratio > 1")]),
    ("daily_revenue_summary", "filled", "daily_revenue_key", "revenue_date", [
        ("accepted_range", "order_count", "order_count < 0")]),
    ("unified_transactions", "ledger", None, "transaction_id transaction_date", [
        ("accepted_values", "transaction_type",
         "transaction_type NOT IN ('order', 'return')")]),
]


def one_check(table: str, check: str, column: str, violations: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, "
        f"'{column}' AS column_name, ({violations}) AS violations"
    )


def repeated(relation: str, columns: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {columns} FROM {relation} GROUP BY {columns} "
        "HAVING count(*) > 1)"
    )


def check_report(parts: list[str]) -> str:
    return ask(
        "table_name check_name column_name violations# status",
        "FROM (SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status "
        f"FROM ({' UNION ALL '.join(parts)}))",
    )


def marts_quality_sql() -> str:
    parts = []
    for table, relation, unique, required, rules in MART_PARTS:
        if unique:
            parts.append(one_check(table, "unique", unique, repeated(relation, unique)))
        for name in required.split():
            found = f"SELECT count(*) FROM {relation} WHERE {name} IS NULL"
            parts.append(one_check(table, "not_null", name, found))
        for check, column, broken in rules:
            found = f"SELECT count(*) FROM {relation} WHERE {broken}"
            parts.append(one_check(table, check, column, found))
    return check_report(parts)


def quality_sql() -> str:
    parts = []

    def add(table: str, check: str, column: str, violations: str) -> None:
        parts.append(one_check(table, check, column, violations))

    for table, (relation, names) in RAW_PARTS.items():
        for name in names.split():
            add(table, "not_null", name, f"SELECT count(*) FROM {relation} WHERE {name} IS NULL")
    for table, (relation, col) in UNIQUE_PARTS.items():
        add(table, "unique", col,
            f"SELECT count(*) FROM (SELECT {col} FROM {relation} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)")  # fmt: skip
        for name in NOT_NULL_PARTS[table].split():
            add(table, "not_null", name,
                f"SELECT count(*) FROM {relation} WHERE {name} IS NULL")
    for table, check, col, broken in ROW_PARTS:
        add(table, check, col, f"SELECT count(*) FROM {UNIQUE_PARTS[table][0]} WHERE {broken}")
    for table, col, parent, pcol in PARENT_PARTS:
        add(table, "relationships", col,
            f"SELECT count(*) FROM {UNIQUE_PARTS[table][0]} c WHERE c.{col} IS NOT NULL AND "
            f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")  # fmt: skip
    return check_report(parts)


def freshness_sql(as_of: str) -> str:
    parts = []
    for name, relation, warn, error in (
        ("users", "s_users", 7, 14),
        ("products", "s_products", 30, 60),
        ("orders", "s_orders", 3, 7),
        ("order_items", "s_items", 3, 7),
        ("returns", "s_returns", 7, 14),
    ):
        parts.append(
            f"SELECT '{name}' AS source, {warn} AS warn, {error} AS error, "
            f"max(ingested_at) AS max_loaded_at FROM {relation}"
        )
    return ask(
        "source max_loaded_at@ age_days# status",
        f"""FROM (SELECT *, CASE WHEN age_days IS NULL OR age_days > error THEN 'error'
                              WHEN age_days > warn THEN 'warn' ELSE 'pass' END AS status
                  FROM (SELECT *, date_diff('day', max_loaded_at, DATE '{as_of}') AS age_days
                        FROM ({" UNION ALL ".join(parts)})))""",
    )


ROLLING = """FROM (SELECT *,
    CAST(sum(total_revenue) OVER (series ROWS 6 PRECEDING) AS DOUBLE)
        / CAST(count(*) OVER (series ROWS 6 PRECEDING) AS DOUBLE) AS revenue_7day_avg,
    sum(total_revenue) OVER (series ROWS 29 PRECEDING) AS revenue_30day_total,
    sum(total_revenue) OVER (series ROWS UNBOUNDED PRECEDING) AS running_revenue,
    lag(total_revenue) OVER series AS previous_revenue
  FROM (SELECT status, order_date, sum(net_sales) AS total_revenue FROM metrics
        GROUP BY status, order_date)
  WINDOW series AS (PARTITION BY status ORDER BY order_date))"""

ORACLE_SQL = {
    "stg_users": ask(USERS, "FROM s_users"),
    "stg_products": ask(
        "product_id product_name category supplier_id# unit_cost$ ingested_at@", "FROM s_products"
    ),
    "stg_orders": ask(f"{ORDERS} ingested_at@", "FROM s_orders"),
    "stg_order_items": ask(f"{ITEMS} ingested_at@", "FROM s_items"),
    "stg_returns": ask(f"{RETURNS} ingested_at@", "FROM s_returns"),
    "returns_with_item": ask(f"{RETURNS} order_id product_id quantity#", "FROM returned"),
    "returns_with_order": ask(
        f"{RETURNS} order_id product_id quantity# user_id order_date@ status",
        "FROM returned JOIN (SELECT order_id, user_id, order_date, status FROM s_orders) "
        "USING (order_id)",
    ),
    "order_metrics": ask(METRICS, "FROM metrics"),
    "order_surrogate_key": ask(
        "order_id order_surrogate_key",
        f"FROM (SELECT order_id, {key('order_id', 'user_id', 'order_date')} "
        "AS order_surrogate_key FROM s_orders)",
    ),
    "customer_lifetime": ask(f"user_id {LIFETIME}", "FROM lifetime"),
    "dim_customers": ask(DIM, "FROM dim"),
    "customer_segment_performance": ask(SEGMENTS, "FROM segments"),
    "completed_items": ask(ITEMS, "FROM done_items"),
    "product_performance": ask(PERFORMANCE, "FROM products_perf"),
    "mart_product_performance": ask(
        f"{PERFORMANCE} return_rate$ profit_margin_after_returns$ roi_after_returns$",
        "FROM rated",
    ),
    "dim_products": ask(
        "product_id product_name category supplier_id# unit_cost$ orders_sold# "
        "total_units_sold# gross_sales$ is_sold",
        "FROM (SELECT *, total_units_sold > 0 AS is_sold FROM products_perf)",
    ),
    "primary_product": ask(f"order_id {MAIN_PRODUCT}", "FROM main_product"),
    "primary_product_top_n": ask(
        "order_id product_id product_quantity# product_sales$ product_lines#",
        """FROM (SELECT order_id, product_id, sum(quantity) AS product_quantity,
                  sum(gross_item_sales) AS product_sales, count(*) AS product_lines
           FROM s_items GROUP BY order_id, product_id)
           QUALIFY row_number() OVER (PARTITION BY order_id
               ORDER BY product_quantity DESC, product_sales DESC, product_id) = 1""",
    ),
    "category_mix": ask("order_id distinct_categories#", "FROM mix"),
    "fct_orders": ask(FACTS, "FROM facts"),
    "date_bounds": ask(
        "min_date@ max_date@",
        "FROM (SELECT min(order_date) AS min_date, max(order_date) AS max_date "
        "FROM s_orders WHERE is_completed)",
    ),
    "date_spine": ask(
        "date_day@ order_count#",
        """FROM (SELECT d AS date_day, count(order_id) AS order_count
           FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31',
                                                    INTERVAL 1 DAY)) AS DATE) AS d)
           LEFT JOIN s_orders ON order_date = d GROUP BY d)""",
    ),
    "daily_revenue": ask(f"order_date@ {DIMS} {DAY_MEASURES}", "FROM per_day"),
    "daily_revenue_on_spine": ask(
        DAY_ROW,
        f"""FROM (SELECT d AS revenue_date, {SERIES},
              {key("d", "customer_segment", "loyalty_tier", "primary_product_category")}
                  AS daily_revenue_key,
              coalesce(order_count, 0) AS order_count,
              coalesce(unique_customers, 0) AS unique_customers,
              coalesce(total_units_sold, 0) AS total_units_sold,
              coalesce(total_revenue, 0) AS total_revenue,
              coalesce(total_gross_sales, 0) AS total_gross_sales,
              coalesce(total_refunds, 0) AS total_refunds, avg_order_value
            FROM (SELECT CAST(unnest(generate_series(DATE '1994-12-25', DATE '2001-08-10',
                                                     INTERVAL 1 DAY)) AS DATE) AS d)
            LEFT JOIN per_day ON order_date = d)""",
    ),
    "daily_revenue_dense": ask(DAY_ROW, "FROM dense"),
    "rolling_7day_avg": ask("status order_date@ total_revenue$ revenue_7day_avg$", ROLLING),
    "rolling_30day_total": ask(
        "status order_date@ total_revenue$ revenue_30day_total$", ROLLING
    ),
    "running_total_and_lag": ask(
        "status order_date@ total_revenue$ running_revenue$ previous_revenue$", ROLLING
    ),
    "days_since_segment_start": ask(
        "customer_segment order_date@ days_since_segment_start#",
        """FROM (SELECT DISTINCT customer_segment, order_date,
                  date_diff('day', min(order_date) OVER (PARTITION BY customer_segment),
                            order_date) AS days_since_segment_start
           FROM s_orders o JOIN s_users u ON u.user_id = o.user_id WHERE is_completed)""",
    ),
    "customer_share_of_country": ask(
        "customer_id country lifetime_revenue$ cumulative_pct$",
        """FROM (SELECT *,
              CAST(sum(lifetime_revenue) OVER (
                       PARTITION BY country ORDER BY lifetime_revenue DESC, customer_id
                       ROWS UNBOUNDED PRECEDING) AS DOUBLE) * 100.0 / nullif(CAST(whole AS DOUBLE), 0)
                  AS cumulative_pct
            FROM (SELECT *, sum(lifetime_revenue) OVER (PARTITION BY country) AS whole
                  FROM dim WHERE is_active_customer))""",
    ),
    "customer_revenue_share": ask(
        "customer_id customer_segment lifetime_revenue$ pct_of_segment$ cumulative_pct$",
        """FROM (SELECT *,
              CAST(lifetime_revenue AS DOUBLE) * 100.0 / CAST(whole AS DOUBLE)
                  AS pct_of_segment,
              CAST(sum(lifetime_revenue) OVER (
                       PARTITION BY customer_segment
                       ORDER BY lifetime_revenue DESC, customer_id
                       ROWS UNBOUNDED PRECEDING) AS DOUBLE) * 100.0 / CAST(whole AS DOUBLE)
                  AS cumulative_pct
            FROM (SELECT *, sum(lifetime_revenue) OVER (PARTITION BY customer_segment) AS whole
                  FROM dim WHERE is_active_customer))""",
    ),
    "segment_share_of_tier": ask(
        "customer_segment loyalty_tier total_segment_revenue$ pct_of_tier$",
        """FROM (SELECT *, CASE WHEN whole <> 0 THEN
                  CAST(total_segment_revenue AS DOUBLE) * 100.0 / CAST(whole AS DOUBLE)
              END AS pct_of_tier
            FROM (SELECT *, sum(total_segment_revenue) OVER (PARTITION BY loyalty_tier)
                      AS whole FROM segments))""",
    ),
    "recent_orders": ask(
        f"{ORDERS} ingested_at@", "FROM s_orders WHERE order_date >= DATE '2001-02-01'"
    ),
    "daily_revenue_summary": summary("filled"),
    "daily_revenue_summary_dense": summary("dense"),
    "weekly_revenue": ask(
        f"week_start_date@ {DIMS} order_count# total_units_sold# total_revenue$ "
        "total_gross_sales$ total_refunds$",
        f"""FROM (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start_date,
              {SERIES}, count(*) AS order_count, sum(total_item_quantity) AS total_units_sold,
              sum(net_sales) AS total_revenue, sum(gross_item_sales) AS total_gross_sales,
              sum(total_refund_amount) AS total_refunds
            FROM facts WHERE is_completed GROUP BY ALL)""",
    ),
    "unified_transactions": ask(
        "transaction_id transaction_date@ customer_id transaction_type transaction_amount$ "
        "effective_date@ source_table",
        "FROM (SELECT *, transaction_date AS effective_date, "
        "'unified_transactions' AS source_table FROM ledger)",
    ),
    "union_relations": ask(
        "order_id user_id order_date@ status is_completed total_amount$ return_id order_item_id "
        "return_date@ return_reason refund_amount$ _source_relation",
        """FROM (SELECT *, 'orders' AS _source_relation FROM s_orders UNION ALL BY NAME
                 SELECT *, 'returns' AS _source_relation FROM s_returns)""",
    ),
    "pivot_revenue": ask(
        "customer_segment VIP$ GROWTH$ NEW$ PROSPECT$",
        """FROM (SELECT customer_segment,
              coalesce(sum(lifetime_revenue) FILTER (WHERE loyalty_tier = 'VIP'), 0) AS VIP,
              coalesce(sum(lifetime_revenue) FILTER (WHERE loyalty_tier = 'GROWTH'), 0)
                  AS GROWTH,
              coalesce(sum(lifetime_revenue) FILTER (WHERE loyalty_tier = 'NEW'), 0) AS NEW,
              coalesce(sum(lifetime_revenue) FILTER (WHERE loyalty_tier = 'PROSPECT'), 0)
                  AS PROSPECT
            FROM dim GROUP BY customer_segment)""",
    ),
    "unpivot_metrics": ask(
        "customer_segment loyalty_tier metric value$",
        "FROM ("
        + " UNION ALL ".join(
            f"SELECT customer_segment, loyalty_tier, '{m}' AS metric, "
            f"CAST({m} AS DOUBLE) AS value FROM segments"
            for m in ("customer_count", "active_customer_count", "total_segment_revenue",
                      "active_customer_ratio")
        )
        + ")",
    ),
    "column_values": ask(
        "value n#", "FROM (SELECT status AS value, count(*) AS n FROM s_orders GROUP BY status)"
    ),
    "enriched_orders": ask(ENRICHED, "FROM enriched"),
    "monthly_segment_metrics": ask(MONTHLY, "FROM monthly"),
    "segment_trends": ask(f"{MONTHLY} {RATES}", "FROM trends"),
    "segment_month_trend": ask(
        "customer_segment order_month@ order_count# total_net_sales$ running_revenue$ "
        "previous_month_revenue$ month_end@ mom_growth_rate_pct$ growth_status",
        f"""FROM (SELECT *, {GROWTH_LABEL} AS growth_status FROM (
              SELECT *, last_day(order_month) AS month_end,
                     CASE WHEN previous_month_revenue > 0
                          THEN CAST(total_net_sales - previous_month_revenue AS DOUBLE)
                               / CAST(previous_month_revenue AS DOUBLE) * 100.0
                     END AS mom_growth_rate_pct
              FROM (SELECT *, sum(total_net_sales) OVER (w ROWS UNBOUNDED PRECEDING)
                                  AS running_revenue,
                           lag(total_net_sales) OVER w AS previous_month_revenue
                    FROM (SELECT customer_segment,
                                 CAST(date_trunc('month', order_date) AS DATE) AS order_month,
                                 count(*) AS order_count, sum(net_sales) AS total_net_sales
                          FROM enriched GROUP BY ALL)
                    WINDOW w AS (PARTITION BY customer_segment ORDER BY order_month))))""",
    ),
    "product_segment_performance": ask(RANKED, "FROM ranked_products"),
    "top_products": ask(RANKED, "FROM ranked_products WHERE revenue_rank_in_category <= 5"),
    "customer_ltv_by_category": ask(
        f"customer_id {DIMS} orders_in_category# category_lifetime_value$ last_order_date@ "
        "first_order_date@ customer_tenure_days# ltv_rank_in_segment_category#",
        "FROM ltv",
    ),
    "ltv_statistics": ask(
        "customer_segment primary_product_category total_customers# avg_category_ltv$ "
        "median_category_ltv$ p75_category_ltv$ p90_category_ltv$ p95_category_ltv$ "
        "max_category_ltv$ avg_orders_per_customer$ avg_tenure_days$",
        "FROM ltv_stats",
    ),
    "high_value_opportunities": ask(
        f"{DIMS} primary_product_id primary_product_name vip_customer_count# "
        "revenue_from_vip$ avg_vip_order_value$ opportunity_tier",
        "FROM vip_demand",
    ),
    "segment_product_analysis": ask(
        f"order_month@ {DIMS} total_net_sales$ total_gross_sales$ "
        "segment_running_total_revenue$ mom_growth_rate_pct$ order_count# unique_customers# "
        "avg_order_value$ total_returns# return_rate_pct$ refund_rate_pct$ primary_product_id "
        "primary_product_name revenue_rank_in_category# pct_of_segment_revenue$ "
        "cumulative_revenue_pct$ avg_category_ltv$ median_category_ltv$ p90_category_ltv$ "
        "avg_orders_per_customer$ opportunity_tier revenue_from_vip$ vip_customer_count# "
        "growth_status pareto_classification return_risk_level",
        REPORT,
    ),
    "check_unique": ask(
        "user_id n#",
        "FROM (SELECT user_id, count(*) AS n FROM s_orders GROUP BY user_id) WHERE n > 1",
    ),
    "check_unique_combination": ask(
        "order_id product_id quantity# n#",
        "FROM (SELECT order_id, product_id, quantity, count(*) AS n FROM s_items GROUP BY ALL) "
        "WHERE n > 1",
    ),
    "check_not_null": ask(
        "order_id order_date@",
        "FROM s_orders WHERE order_id NOT IN (SELECT order_id FROM main_product)",
    ),
    "check_relationships": ask(
        "order_item_id order_id",
        "FROM s_items WHERE order_id NOT IN (SELECT order_id FROM s_orders WHERE is_completed)",
    ),
    "check_accepted_values": ask(
        "value n#",
        """FROM (SELECT customer_segment AS value, count(*) AS n FROM s_users
           WHERE customer_segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
           GROUP BY customer_segment)""",
    ),
    "check_range": ask(
        "order_item_id quantity# gross_item_sales$",
        "FROM s_items WHERE quantity < 3 OR quantity > 48",
    ),
    "check_net_sales": ask(
        "order_id gross_item_sales$ total_refund_amount$ net_sales$ calculated_net_sales$ "
        "difference$",
        """FROM (SELECT order_id, gross_item_sales, total_refund_amount,
                  order_total_amount AS net_sales, net_sales AS calculated_net_sales,
                  abs(order_total_amount - net_sales) AS difference FROM metrics)
           WHERE difference > 0.01""",
    ),
    "check_return_dates": ask(
        "return_id return_date@ order_date@ order_id",
        "FROM returned JOIN (SELECT order_id, order_date FROM s_orders) USING (order_id) "
        "WHERE return_date < order_date",
    ),
    "check_gross_sales": ask(
        "order_item_id quantity# unit_price$ gross_item_sales$ calculated_gross_sales$ "
        "difference$",
        """FROM (SELECT i.order_item_id, i.quantity, i.unit_price,
                  r.refund_amount AS gross_item_sales,
                  i.gross_item_sales AS calculated_gross_sales,
                  abs(r.refund_amount - i.gross_item_sales) AS difference
           FROM s_items i JOIN s_returns r ON r.order_item_id = i.order_item_id)
           WHERE difference > 0.01""",
    ),
    "check_freshness": freshness_sql("2001-11-09"),
    "check_expression": ask("order_item_id unit_price$", "FROM s_items WHERE unit_price < 100"),
    "check_recency": ask(
        "newest@ age_days#",
        """FROM (SELECT max(order_date) AS newest,
                  date_diff('day', max(order_date), DATE '2001-12-01') AS age_days
           FROM s_orders) WHERE newest IS NULL OR age_days > 3""",
    ),
    "check_at_least_one": ask(
        "n# part",
        """FROM (SELECT 'without lines' AS part, count(primary_product_id) AS n FROM facts
                 WHERE coalesce(line_item_count, 0) = 0
                 UNION ALL SELECT 'with lines', count(primary_product_id) FROM facts
                 WHERE line_item_count > 0)
           WHERE n = 0""",
    ),
    "check_row_count": ask("n#", "FROM (SELECT count(*) AS n FROM s_items) WHERE n > 1000"),
    "check_distribution": ask(
        "statistic value$ lower_bound$ upper_bound$",
        f"""FROM (SELECT 'mean' AS statistic, {mean("quantity")} AS value, 0.0 AS lower_bound,
                    10.0 AS upper_bound FROM s_items
              UNION ALL SELECT 'min', min(quantity), 2.0, NULL FROM s_items
              UNION ALL SELECT 'max', max(quantity), NULL, 40.0 FROM s_items)
            WHERE value < lower_bound OR value > upper_bound""",
    ),
    "check_distribution_quantiles": ask(
        "column_name statistic value$ lower_bound$ upper_bound$",
        f"""FROM (SELECT 'gross_item_sales' AS column_name, 'p50' AS statistic, {discrete("0.5")} AS value,
                    0.0 AS lower_bound, 100.0 AS upper_bound FROM sales_places
              UNION ALL SELECT 'gross_item_sales', 'p95', {discrete("0.95")}, 0.0, 1000.0 FROM sales_places
              UNION ALL SELECT 'gross_item_sales', 'stddev', round(stddev_samp(v), 4), NULL, 1.0 FROM sales_places
              UNION ALL SELECT 'quantity', 'p90', {discrete("0.9")}, NULL, 2.0 FROM quantity_places)
            WHERE value < lower_bound OR value > upper_bound""",
    ),
    "check_freshness_footers": """
        WITH newest AS (
          SELECT 'orders' AS source, max(CAST(o_orderdate AS DATE)) AS d, 3 AS warn, 7 AS err FROM orders
          UNION ALL SELECT 'order_items', max(CAST(l_shipdate AS DATE)), 3, 7 FROM lineitem
          UNION ALL SELECT 'returns', max(CAST(l_shipdate AS DATE)), 7, 14 FROM lineitem WHERE l_returnflag = 'R')
        SELECT source, d AS max_loaded_at, CAST(date_diff('day', d, DATE '2001-08-08') AS BIGINT) AS age_days,
               CASE WHEN date_diff('day', d, DATE '2001-08-08') > err THEN 'error'
                    WHEN date_diff('day', d, DATE '2001-08-08') > warn THEN 'warn' ELSE 'pass' END AS status
        FROM newest""",
    "orders_clustered": ask(
        f"{ORDERS} order_month@",
        "FROM (SELECT *, date_trunc('month', order_date) AS order_month FROM s_orders) "
        "WHERE user_id BETWEEN 100 AND 199",
    ),
    "load_users": loaded(
        "user_id email signup_date@ country customer_segment",
        "(SELECT * REPLACE (DATE '2020-01-01' + CAST(user_id % 1000 AS INTEGER) AS signup_date) FROM s_users)",
        "user_id % 50 NOT IN (7, 9)",
        "CAST(user_id AS VARCHAR)",
        "CASE user_id % 50 WHEN 7 THEN 'record: wrong number of fields' ELSE 'signup_date: no date' END",
    ),
    "load_products": loaded(
        "product_id product_name category supplier_id# unit_cost$",
        "s_products",
        "product_id % 50 NOT IN (7, 9)",
        "CASE WHEN product_id % 50 = 7 THEN CAST(product_id AS VARCHAR) END",
        "CASE product_id % 50 WHEN 7 THEN 'cost: no decimal' ELSE 'product_id: missing' END",
    ),
    "load_orders": loaded(
        ORDERS,
        "s_orders",
        "order_id % 50 NOT IN (7, 9)",
        "CAST(order_id AS VARCHAR)",
        "CASE order_id % 50 WHEN 7 THEN 'order_date: no date' ELSE 'record: wrong number of fields' END",
    ),
    "load_order_items": loaded(
        ITEMS,
        "s_items",
        "order_id % 50 <> 7",
        "order_item_id",
        "CASE WHEN order_id % 100 = 7 THEN 'quantity: no int; price: no decimal' ELSE 'quantity: no int' END",
    ),
    "load_returns": loaded(
        RETURNS,
        "s_returns",
        "return_id >= '1' AND return_id < 'f'",
        "return_id",
        "CASE WHEN return_id < '1' THEN 'refund_amount: no decimal' ELSE 'record: wrong number of fields' END",
    ),
    "quality_report": quality_sql(),
    "quality_report_marts": marts_quality_sql(),
    "reprocess_window": ask(
        f"{ORDERS} ingested_at@",
        "FROM s_orders WHERE order_date >= (SELECT max(order_date) FROM s_orders "
        "WHERE order_date < DATE '2001-06-01') - INTERVAL 14 DAY",
    ),
    "upsert": ask(
        ORDERS,
        "FROM (SELECT * REPLACE (CASE status WHEN 'pending' THEN 'cancelled' ELSE status END "
        "AS status) FROM s_orders)",
    ),
    "fct_orders_incremental": ask(KEPT_FACTS, "FROM facts"),
    "fct_orders_stream": ask(KEPT_FACTS, "FROM facts"),
    "fct_orders_published": ask(KEPT_FACTS, "FROM facts"),
    "fct_orders_old_orders": ask(KEPT_FACTS, "FROM facts"),
    "fct_orders_stream_early_returns": ask(KEPT_FACTS, "FROM facts"),
    "daily_revenue_stream": EVENT_TOTALS,
    "daily_revenue_two_streams": EVENT_TOTALS,
    "write_read_partitioned": ask(
        f"{ORDERS} order_month@",
        "FROM (SELECT *, date_trunc('month', order_date) AS order_month FROM s_orders)",
    ),
    "raw_csv_round_trip": ask(f"{ORDERS} ingested_at@", "FROM s_orders"),
    "orders_view_sql": ask(
        "order_id status is_completed", "FROM s_orders"
    ),
    "product_cost_history": ask(
        "product_id unit_cost$ valid_from@ valid_to@ is_current",
        """FROM (SELECT *, valid_to IS NULL AS is_current FROM (
             SELECT product_id, unit_cost, seen_on AS valid_from,
                    lead(seen_on) OVER (PARTITION BY product_id ORDER BY seen_on) AS valid_to
             FROM (SELECT *, lag(unit_cost) OVER (PARTITION BY product_id ORDER BY seen_on)
                                 AS before FROM seen_costs)
             WHERE before IS NULL OR before <> unit_cost))""",
    ),
    "product_cost_merge": with_relations(
        """, spans AS (
          SELECT product_id, CASE WHEN seen_on < DATE '1997-01-01' THEN 1
                                  WHEN seen_on < DATE '1999-01-01' THEN 2 ELSE 3 END AS step,
                 max(unit_cost) AS cost
          FROM seen_costs GROUP BY ALL),
        steps AS (
          SELECT product_id,
                 max(cost) FILTER (WHERE step = 1) AS c1, max(cost) FILTER (WHERE step = 2) AS c2,
                 max(cost) FILTER (WHERE step = 3) AS c3
          FROM spans GROUP BY product_id),
        known AS (SELECT *, coalesce(c2, c1) AS held,
                         CASE WHEN c1 IS NULL OR c2 <> c1 THEN DATE '1999-01-01'
                              ELSE DATE '1997-01-01' END AS since FROM steps),
        rows_out AS (
          SELECT product_id, c1 AS cost, DATE '1997-01-01' AS valid_from,
                 DATE '1999-01-01' AS valid_to FROM known WHERE c1 IS NOT NULL AND c2 <> c1
          UNION ALL
          SELECT product_id, held, since,
                 CASE WHEN c3 IS NULL OR c3 <> held THEN DATE '2002-01-01' END
          FROM known WHERE held IS NOT NULL
          UNION ALL
          SELECT product_id, c3, DATE '2002-01-01', NULL
          FROM known WHERE c3 IS NOT NULL AND (held IS NULL OR c3 <> held))
        SELECT product_id, CAST(cost AS DOUBLE) AS unit_cost, valid_from, valid_to,
               valid_to IS NULL AS is_current
        FROM rows_out"""
    ),
}
