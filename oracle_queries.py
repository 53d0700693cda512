"""SQL counterparts of the registered queries, for DuckDB over the same Parquet tables.

Written independently of the Spark plans: plain windows instead of split ones, anti joins
instead of aggregates, joins before aggregation.
"""

from __future__ import annotations

# The four relations, as in ordermill.sources.testdata.
_SHOP = """
shop_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         first_order + to_days(CAST(c_custkey % 61 - 30 AS INTEGER)) AS registration_date,
         c_mktsegment AS customer_type
  FROM customer
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
    ON f.o_custkey = c_custkey
),
shop_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS subcategory, CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DOUBLE) AS cost_price
  FROM part
),
shop_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PLACED'
                            WHEN 'P' THEN 'RETURNED' ELSE o_orderstatus END AS status,
         r_name AS region_code
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
shop_items AS (
  SELECT 'ITEM_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey AS item_id,
         l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS unit_price,
         round(l_discount * 100, 2) AS discount_percent
  FROM lineitem
),
lines AS (
  SELECT *, CAST(quantity AS DECIMAL(10,0)) * unit_price
            * (1 - CAST(discount_percent AS DECIMAL(5,2)) * 0.01) AS rev
  FROM shop_items
),
sold AS (
  SELECT o.*, l.product_id, l.quantity, l.rev
  FROM shop_orders o JOIN lines l ON l.order_id = o.order_id
)"""

# The dirtied relations, as in ordermill.plans.anomalies.
_DIRTY = (
    _SHOP
    + """,
dirty_customers AS (
  SELECT customer_id, customer_name,
         CASE customer_id % 100 WHEN 0 THEN replace(email, '@', '')
                                WHEN 50 THEN split_part(email, '@', 1) ELSE email END AS email,
         registration_date, customer_type
  FROM shop_customers
),
dirty_products AS (
  SELECT product_id,
         CASE product_id % 40 WHEN 0 THEN '  ' || lower(product_name) || '  '
                              WHEN 20 THEN upper(product_name) ELSE product_name END
           AS product_name,
         category, subcategory, cost_price
  FROM shop_products
),
real_dates AS (
  SELECT order_id, CASE WHEN order_id % 20 <> 0 THEN customer_id END AS customer_id,
         CASE WHEN order_id % 211 = 9 THEN order_date + INTERVAL 100 YEAR ELSE order_date END
           AS order_date,
         status, region_code
  FROM shop_orders
),
dirty_orders AS (
  SELECT order_id, customer_id,
         CASE WHEN order_id % 20 = 7 THEN strftime(order_date, '%d-%m-%Y %H:%M:%S')
              ELSE strftime(order_date, '%Y-%m-%d %H:%M:%S') END AS order_date,
         status, region_code
  FROM real_dates
),
dirty_items AS (
  SELECT item_id,
         CASE WHEN slot % 89 = 6 THEN -1 - order_id ELSE order_id END AS order_id,
         product_id,
         CASE WHEN slot % 101 = 4 THEN 0 WHEN slot % 33 = 1 THEN -quantity
              ELSE quantity END AS quantity,
         CAST(unit_price AS DOUBLE) AS unit_price,
         CASE slot % 97 WHEN 3 THEN 150.0 WHEN 5 THEN -5.0 ELSE discount_percent END
           AS discount_percent
  FROM (SELECT *, CAST('0x' || substr(md5(item_id), 1, 8) AS UBIGINT) AS slot FROM shop_items)
),
tidy_products AS (
  SELECT * REPLACE (array_to_string(list_transform(
           string_split(trim(regexp_replace(lower(product_name), '\\s+', ' ', 'g')), ' '),
           lambda w: upper(w[1]) || w[2:]), ' ') AS product_name)
  FROM dirty_products
)"""
)

_STAMP = "'%Y-%m-%d %H:%M:%S'"
_DAY = "'%Y-%m-%d'"


def _shop(body: str) -> str:
    return f"WITH {_SHOP.strip()}\n{body.strip()}"


def _dirty(body: str) -> str:
    return f"WITH {_DIRTY.strip()}\n{body.strip()}"


def _money(amount: str) -> str:
    return f"CAST(round({amount}, 2) AS DOUBLE)"


def _ratio(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,8)), 2) AS DOUBLE)"


def _percent(part: str, whole: str) -> str:
    return _ratio(f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100")


def _change(now: str, before: str) -> str:
    return (
        f"CASE WHEN {before} = 0 THEN CASE WHEN {now} > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END"
        f" ELSE {_percent(f'({now} - {before})', before)} END"
    )


_PER_CUSTOMER = """
value AS (
  SELECT customer_id, sum(rev) AS v FROM sold WHERE customer_id IS NOT NULL GROUP BY customer_id
)"""

_ACTIVITY = """
activity AS (
  SELECT c.customer_id, strftime(c.registration_date, '%Y-%m') AS cohort_month,
         CAST(trunc(date_diff('day', CAST(date_trunc('month', c.registration_date) AS DATE),
                              CAST(o.order_date AS DATE)) / 30.0) AS BIGINT) AS month_number
  FROM shop_customers c JOIN shop_orders o ON o.customer_id = c.customer_id
),
active AS (
  SELECT cohort_month, month_number, count(DISTINCT customer_id) AS active_users
  FROM activity WHERE month_number BETWEEN 0 AND 3 GROUP BY ALL
)"""

_START, _END, _PREV_START, _PREV_END = "2000-03-01", "2000-03-31", "2000-01-30", "2000-02-29"


def _period_totals(first: str, last: str) -> str:
    return f"""
  SELECT count(DISTINCT order_id) AS n_orders, count(DISTINCT customer_id) AS n_customers,
         coalesce({_money("sum(rev)")}, 0.0) AS revenue
  FROM sold
  WHERE order_date >= TIMESTAMP '{first} 00:00:00' AND order_date <= TIMESTAMP '{last} 23:59:59'"""


def _grain(grain: str) -> str:
    return _shop(f""",
buckets AS (
  SELECT CAST(date_trunc('{grain}', order_date) AS DATE) AS b,
         count(DISTINCT order_id) AS n, count(DISTINCT customer_id) AS c,
         {_money("sum(rev)")} AS r
  FROM sold GROUP BY 1
),
pairs AS (
  SELECT *, lag(n) OVER (ORDER BY b) AS pn, lag(r) OVER (ORDER BY b) AS pr FROM buckets
)
SELECT strftime(b, {_DAY}) AS period_start, n AS total_orders, c AS unique_customers,
       r AS total_revenue, {_change("r", "pr")} AS revenue_change,
       {_change("n", "pn")} AS orders_change
FROM pairs""")


_TIMED = """
, timed AS (SELECT order_id, order_date + to_hours(order_id % 24) AS order_date FROM real_dates)
"""

_SPOILED = """
, spoiled AS (
  SELECT *, order_id % 50 = 3 AS junk FROM real_dates WHERE customer_id IS NOT NULL
)"""


def _findings(*more: str) -> str:
    """The pipeline's report; ``more`` are further rows."""
    rows = """
SELECT 'null_customer_orders' AS "check", count(*) AS n, '' AS sample
FROM real_dates WHERE customer_id IS NULL
UNION ALL
SELECT 'orphan_items', count(*), '' FROM dirty_items i
WHERE NOT EXISTS (SELECT 1 FROM real_dates o
                  WHERE o.order_id = i.order_id AND o.customer_id IS NOT NULL)
UNION ALL
SELECT 'invalid_emails', count(*), (
         SELECT string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY customer_id)
         FROM (SELECT customer_id FROM shop_customers
               WHERE customer_id % 50 = 0 ORDER BY customer_id LIMIT 3))
FROM shop_customers WHERE customer_id % 50 = 0"""
    return _dirty("\nUNION ALL\n".join([rows, *more]))


_CLEANED = {
    "customers": f"""
SELECT * REPLACE (strftime(registration_date, {_STAMP}) AS registration_date)
FROM dirty_customers""",
    "products": "SELECT * FROM tidy_products",
    "orders": f"""
SELECT * REPLACE (strftime(order_date, {_STAMP}) AS order_date)
FROM real_dates WHERE customer_id IS NOT NULL""",
    "order_items": "SELECT * REPLACE (abs(quantity) AS quantity) FROM dirty_items",
}

_RAW = {
    "customers": f"""
SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_name, email,
       strftime(registration_date, {_STAMP}) AS registration_date, customer_type
FROM dirty_customers""",
    "products": """
SELECT * REPLACE (CAST(product_id AS VARCHAR) AS product_id) FROM dirty_products""",
    "orders": """
SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id,
                  CAST(customer_id AS VARCHAR) AS customer_id) FROM dirty_orders""",
    "order_items": """
SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id,
                  CAST(product_id AS VARCHAR) AS product_id) FROM dirty_items""",
}

ORACLE_SQL = {
    "q01_category_revenue": _shop(f"""
SELECT category, {_money("sum(rev)")} AS total_revenue
FROM lines JOIN shop_products USING (product_id) GROUP BY category"""),
    "q02_top_customers": _shop(f"""
SELECT customer_id, customer_name, {_money("sum(rev)")} AS total_order_value
FROM sold JOIN shop_customers USING (customer_id)
GROUP BY customer_id, customer_name
ORDER BY total_order_value DESC, customer_id LIMIT 10"""),
    "q03_monthly_orders": _shop("""
SELECT strftime(order_date, '%Y-%m') AS order_month, count(DISTINCT order_id) AS total_orders
FROM shop_orders WHERE order_date >= TIMESTAMP '2000-08-01' GROUP BY 1"""),
    "q04_never_delivered": _shop("""
SELECT DISTINCT c.customer_id, c.customer_name
FROM shop_customers c
WHERE EXISTS (SELECT 1 FROM shop_orders o WHERE o.customer_id = c.customer_id)
  AND NOT EXISTS (SELECT 1 FROM shop_orders o
                  WHERE o.customer_id = c.customer_id AND o.status = 'DELIVERED')"""),
    "q05_more_returned": _shop("""
SELECT * FROM (
  SELECT product_id, product_name,
         CAST(coalesce(sum(quantity) FILTER (status = 'RETURNED'), 0) AS BIGINT)
           AS total_returned_qty,
         CAST(coalesce(sum(quantity) FILTER (status <> 'RETURNED'), 0) AS BIGINT)
           AS total_purchased_qty
  FROM sold JOIN shop_products USING (product_id) GROUP BY product_id, product_name)
WHERE total_returned_qty > total_purchased_qty"""),
    "q06_return_rate": _shop(f""",
units AS (
  SELECT category, CAST(coalesce(sum(quantity) FILTER (status = 'RETURNED'), 0) AS BIGINT) AS r,
         CAST(sum(quantity) AS BIGINT) AS t
  FROM sold JOIN shop_products USING (product_id) GROUP BY category
)
SELECT category, r AS returned_items, t AS total_items,
       {_percent("r", "t")} AS return_rate_percentage
FROM units"""),
    "q07_region_running_revenue": _shop(f""",
daily AS (
  SELECT region_code, CAST(order_date AS DATE) AS d, sum(rev) AS v FROM sold GROUP BY ALL
)
SELECT region_code, strftime(d, {_DAY}) AS order_date, {_money("v")} AS daily_revenue,
       {_money("sum(v) OVER (PARTITION BY region_code ORDER BY d)")} AS running_total
FROM daily"""),
    "q08_product_rank": _shop(f""",
names AS (
  SELECT category, product_name, sum(rev) AS v
  FROM lines JOIN shop_products USING (product_id) GROUP BY category, product_name
)
SELECT category, product_name, {_money("v")} AS total_revenue,
       dense_rank() OVER (PARTITION BY category ORDER BY v DESC NULLS LAST) AS rank_in_category
FROM names"""),
    "q09_order_gaps": _shop(f""",
pairs AS (
  SELECT customer_id, order_date, lag(order_date) OVER (
           PARTITION BY customer_id ORDER BY order_date NULLS FIRST) AS earlier
  FROM shop_orders WHERE customer_id IS NOT NULL
),
gaps AS (
  SELECT *, CAST(trunc(epoch(order_date - earlier) / 86400) AS BIGINT) AS days
  FROM pairs WHERE earlier IS NOT NULL
)
SELECT customer_id, strftime(order_date, {_STAMP}) AS order_date,
       strftime(earlier, {_STAMP}) AS previous_order_date, days AS days_gap,
       CASE WHEN avg(days) OVER (PARTITION BY customer_id) > 200 THEN 'At Risk' ELSE 'Safe' END
         AS risk_flag
FROM gaps"""),
    "q10_monthly_value_bands": _shop("""
SELECT order_month, customer_category, count(customer_id) AS customer_count
FROM (
  SELECT customer_id, strftime(order_date, '%Y-%m') AS order_month,
         CASE WHEN sum(rev) > 6500000 THEN 'High' WHEN sum(rev) >= 3500000 THEN 'Medium'
              ELSE 'Low' END AS customer_category
  FROM sold WHERE customer_id IS NOT NULL GROUP BY 1, 2)
GROUP BY ALL"""),
    "q11_ltv_quartiles": _shop(f""",{_PER_CUSTOMER},
tiles AS (
  SELECT *, ntile(4) OVER (ORDER BY v DESC NULLS LAST, customer_id) AS tile FROM value
)
SELECT customer_id, {_money("v")} AS total_value, tile AS quartile,
       ['Platinum', 'Gold', 'Silver', 'Bronze'][tile] AS quartile_label
FROM tiles"""),
    "q12_yoy": _shop(f""",
monthly AS (
  SELECT strftime(order_date, '%Y') AS year, strftime(order_date, '%m') AS month, sum(rev) AS v
  FROM sold GROUP BY 1, 2
),
pairs AS (
  SELECT *, lag(v) OVER (PARTITION BY month ORDER BY year NULLS FIRST) AS w FROM monthly
)
SELECT year, month, {_money("v")} AS revenue, {_money("w")} AS prev_year_revenue,
       {_percent("(v - w)", "w")} AS yoy_growth_percent
FROM pairs"""),
    "q13_category_shift": _shop("""
, bought AS (
  SELECT customer_id, category,
         row_number() OVER (PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id,
                            category) AS up,
         row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC NULLS LAST,
                            order_id DESC, category DESC) AS down
  FROM sold JOIN shop_products USING (product_id) WHERE customer_id IS NOT NULL
),
ends AS (
  SELECT customer_id, max(category) FILTER (up = 1) AS f, max(category) FILTER (down = 1) AS l
  FROM bought GROUP BY customer_id
)
SELECT customer_id, f AS first_purchased_category, l AS most_recent_category,
       CASE WHEN f <> l THEN 'Yes' ELSE 'No' END AS category_shift
FROM ends"""),
    "q14_revenue_concentration": _shop(f""",{_PER_CUSTOMER},
running AS (
  SELECT *, sum(v) OVER (ORDER BY v DESC NULLS LAST) AS up_to, sum(v) OVER () AS everything
  FROM value
)
SELECT customer_id, {_money("v")} AS revenue, {_money("up_to")} AS cumulative_revenue,
       {_percent("up_to", "everything")} AS cumulative_percent
FROM running"""),
    "q15_cohort_activity": _shop(f""",{_ACTIVITY},
wide AS (
  SELECT cohort_month,
         coalesce(max(active_users) FILTER (month_number = 0), 0) AS month_0_active,
         coalesce(max(active_users) FILTER (month_number = 1), 0) AS month_1_active,
         coalesce(max(active_users) FILTER (month_number = 2), 0) AS month_2_active,
         coalesce(max(active_users) FILTER (month_number = 3), 0) AS month_3_active
  FROM active GROUP BY cohort_month
)
SELECT *, {_percent("month_1_active", "month_0_active")} AS retention_rate_month_1
FROM wide ORDER BY cohort_month DESC LIMIT 12"""),
    "q16_retention_rate": _shop(f""",{_ACTIVITY}
SELECT a.cohort_month, a.month_number, a.active_users,
       {_percent("a.active_users", "z.active_users")} AS retention_rate
FROM active a
LEFT JOIN active z ON z.cohort_month = a.cohort_month AND z.month_number = 0"""),
    "c01_clean_orders": _dirty(f"""
SELECT order_id, customer_id, strftime(order_date, {_STAMP}) AS order_date, status, region_code
FROM real_dates WHERE customer_id IS NOT NULL"""),
    "c02_clean_products": _dirty("SELECT * FROM tidy_products"),
    "c03_invalid_emails": _dirty(r"""
SELECT customer_id, email FROM dirty_customers
WHERE email IS NULL OR NOT regexp_full_match(email, '[^@\s]+@[^@\s]+\.[^@\s]+')"""),
    "c04_orphan_items": _dirty("""
SELECT item_id, order_id FROM dirty_items i
WHERE NOT EXISTS (SELECT 1 FROM real_dates o
                  WHERE o.order_id = i.order_id AND o.customer_id IS NOT NULL)"""),
    "c05_abs_quantity": _dirty("SELECT * REPLACE (abs(quantity) AS quantity) FROM dirty_items"),
    "c06_clean_pipeline": _dirty("""
SELECT 'customers' AS "table", count(*) AS rows, 'loaded' AS status FROM dirty_customers
UNION ALL SELECT 'products', count(*), 'loaded' FROM dirty_products
UNION ALL SELECT 'orders', count(customer_id), 'loaded' FROM dirty_orders
UNION ALL SELECT 'order_items', count(*), 'loaded' FROM dirty_items"""),
    "c06_category_revenue_of_cleaned": _dirty(f"""
SELECT category,
       {_money('''sum(CAST(abs(quantity) AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(14,2))
           * (1 - CAST(discount_percent AS DECIMAL(5,2)) * 0.01))''')} AS total_revenue
FROM dirty_items JOIN tidy_products USING (product_id) GROUP BY category"""),
    "c06_rejected_customers": _dirty(r"""
SELECT customer_id, email FROM dirty_customers
WHERE NOT regexp_matches(coalesce(email, ''), '^[^@\s]+@[^@\s]+\.[^@\s]+$')"""),
    "c06_kept_order_items": _dirty("""
SELECT i.* REPLACE (abs(quantity) AS quantity) FROM dirty_items i
WHERE order_id IN (SELECT order_id FROM real_dates WHERE customer_id IS NOT NULL)"""),
    "c07_validation_report": _dirty("""
, bad AS (
  SELECT customer_id FROM dirty_customers
  WHERE email NOT LIKE '%_@_%._%' OR email LIKE '% %' OR email LIKE '%@%@%'
)
SELECT 'null_customer_orders' AS "check", count(*) AS n, '' AS sample
FROM dirty_orders WHERE customer_id IS NULL
UNION ALL
SELECT 'invalid_emails', (SELECT count(*) FROM bad),
       (SELECT string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY customer_id)
        FROM (SELECT customer_id FROM bad ORDER BY customer_id LIMIT 3))
UNION ALL
SELECT 'orphan_items', count(*), '' FROM dirty_items
WHERE order_id NOT IN (SELECT order_id FROM dirty_orders WHERE customer_id IS NOT NULL)"""),
    "d01_orphan_items": _dirty("""
SELECT item_id, order_id FROM dirty_items
WHERE order_id NOT IN (SELECT order_id FROM dirty_orders)"""),
    "d02_bad_discount": _dirty("""
SELECT item_id, discount_percent FROM dirty_items
WHERE NOT discount_percent BETWEEN 0 AND 100"""),
    "d03_zero_quantity": _dirty("SELECT item_id, quantity FROM dirty_items WHERE quantity = 0"),
    "d04_future_orders": _dirty(f"""
{_TIMED}
SELECT order_id, strftime(order_date, {_STAMP}) AS order_date
FROM timed WHERE order_date > TIMESTAMP '2001-07-31 12:00:00'"""),
    "d05_quality_summary": _dirty(f"""
{_TIMED}
SELECT 'orphan_items' AS rule,
       count(*) FILTER (order_id NOT IN (SELECT order_id FROM dirty_orders)) AS violations,
       count(*) AS rows_checked FROM dirty_items
UNION ALL
SELECT 'bad_discount', count(*) FILTER (discount_percent < 0 OR discount_percent > 100), count(*)
FROM dirty_items
UNION ALL
SELECT 'zero_quantity', count(*) FILTER (quantity = 0), count(*) FROM dirty_items
UNION ALL
SELECT 'future_orders', count(*) FILTER (order_date > TIMESTAMP '2001-07-31 12:00:00'), count(*)
FROM timed"""),
    "f13_date_forms": _shop(f"""
SELECT order_id,
       strftime(CASE WHEN order_id % 8 < 5 THEN order_date
                     WHEN order_id % 8 = 6 THEN moment - INTERVAL 330 MINUTE ELSE moment END, {_STAMP})
         AS order_date
FROM (SELECT *, order_date + to_hours(order_id % 24) AS moment FROM shop_orders)"""),
    "p02_three_decimals": _shop(f"""
SELECT category, {_money("sum(fine)")} AS total_revenue
FROM (SELECT product_id,
             CAST(quantity AS DECIMAL(10,0))
             * (unit_price + CAST(product_id % 8 AS DECIMAL(4,0)) * CAST(0.125 AS DECIMAL(4,3)))
             * (1 - (CAST(discount_percent AS DECIMAL(5,2))
                     + CAST(order_id % 4 AS DECIMAL(4,0)) * CAST(0.125 AS DECIMAL(4,3)))
                    * CAST(0.01 AS DECIMAL(3,2))) AS fine
      FROM shop_items)
JOIN shop_products USING (product_id) GROUP BY category"""),
    "r01_period_metrics": _shop(f"""
SELECT n_orders AS total_orders, n_customers AS unique_customers, revenue AS total_revenue
FROM ({_period_totals(_START, _END)})"""),
    "r02_previous_period": _shop(f"""
SELECT 'current' AS period, '{_START}' AS first_day, '{_END}' AS last_day,
       count(*) AS orders_placed
FROM shop_orders WHERE CAST(order_date AS DATE) BETWEEN DATE '{_START}' AND DATE '{_END}'
UNION ALL
SELECT 'previous', '{_PREV_START}', '{_PREV_END}', count(*)
FROM shop_orders WHERE CAST(order_date AS DATE) BETWEEN DATE '{_PREV_START}' AND DATE '{_PREV_END}'
"""),
    "r03_top_products": _shop(f"""
SELECT product_id, product_name, {_money("sum(rev)")} AS product_revenue
FROM sold JOIN shop_products USING (product_id)
WHERE order_date >= TIMESTAMP '{_START} 00:00:00' AND order_date <= TIMESTAMP '{_END} 23:59:59'
GROUP BY product_id, product_name
ORDER BY product_revenue DESC, product_id LIMIT 3"""),
    "r04_executive_summary": _shop(f"""
SELECT '{_START}' AS start_date, '{_END}' AS end_date, '{_PREV_START}' AS prev_start_date,
       '{_PREV_END}' AS prev_end_date, a.revenue AS total_revenue, b.revenue AS prev_revenue,
       a.n_orders AS total_orders, b.n_orders AS prev_orders,
       a.n_customers AS unique_customers,
       {_change("a.revenue", "b.revenue")} AS revenue_change,
       {_change("a.n_orders", "b.n_orders")} AS orders_change
FROM ({_period_totals(_START, _END)}) a, ({_period_totals(_PREV_START, _PREV_END)}) b"""),
    "r05_day_report": _grain("day"),
    "r05_week_report": _grain("week"),
    "r05_month_report": _grain("month"),
    "r05_shared_orders": _shop(f""",
listed AS (
  SELECT order_id, customer_id, order_date FROM shop_orders
  UNION ALL
  SELECT order_id, customer_id + 1, order_date FROM shop_orders WHERE order_id % 10 = 0
),
buckets AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS b,
         count(DISTINCT order_id) AS n, count(DISTINCT customer_id) AS c,
         {_money("sum(rev)")} AS r
  FROM listed JOIN lines USING (order_id) GROUP BY 1
),
pairs AS (
  SELECT *, lag(n) OVER (ORDER BY b) AS pn, lag(r) OVER (ORDER BY b) AS pr FROM buckets
)
SELECT strftime(b, {_DAY}) AS period_start, n AS total_orders, c AS unique_customers,
       r AS total_revenue, {_change("r", "pr")} AS revenue_change,
       {_change("n", "pn")} AS orders_change
FROM pairs"""),
    **{f"s01_csv_{name}": _dirty(sql) for name, sql in _RAW.items()},
    **{f"s03_{how}_{name}": _dirty(sql) for name, sql in _RAW.items() for how in ("view", "managed")},
    **{f"c06_written_{name}": _dirty(sql) for name, sql in _CLEANED.items()},
    **{f"c06_published_{name}": _dirty(_CLEANED[name]) for name in ("orders", "order_items")},
    "c06_pipeline_report": _findings(),
    "c06_rejected_orders": _dirty(f"""{_SPOILED}
SELECT order_id, customer_id,
       'on ' || strftime(order_date, {_STAMP}) AS order_date, status, region_code
FROM spoiled WHERE junk AND order_id % 20 <> 7
UNION ALL
SELECT order_id, customer_id, 'on ' || strftime(order_date, '%d-%m-%Y %H:%M:%S'), status, region_code
FROM spoiled WHERE junk AND order_id % 20 = 7"""),
    "c06_quarantine_report": _findings(
        "SELECT 'bad_order_dates', count(*), '' FROM real_dates"
        " WHERE customer_id IS NOT NULL AND order_id % 50 = 3"
    ),
    "x01_dirty_customers": _dirty(f"""
SELECT * REPLACE (strftime(registration_date, {_STAMP}) AS registration_date)
FROM dirty_customers"""),
    "x01_dirty_products": _dirty("SELECT * FROM dirty_products"),
    "x01_dirty_orders": _dirty("SELECT * FROM dirty_orders"),
    "x01_dirty_order_items": _dirty("SELECT * FROM dirty_items"),
}

# The same reports over tables laid out by month.
ORACLE_SQL |= {
    f"{report[:3]}_monthly_layout": ORACLE_SQL[report]
    for report in ("r01_period_metrics", "r03_top_products", "r04_executive_summary")
}

ORACLE_SQL |= {
    "p11_period_metrics_in_sql": ORACLE_SQL["r01_period_metrics"],
    "p11_top_products_in_sql": "SELECT * REPLACE (CAST(product_id AS VARCHAR) AS product_id) FROM ("
    + ORACLE_SQL["r03_top_products"]
    + ")",
    # The three tables that are there, the one that is not, and a run that needs them all.
    "s04_missing_table": _dirty("""
SELECT 'customers' AS "table", count(*) AS rows, 'loaded' AS status FROM dirty_customers
UNION ALL SELECT 'products', NULL, 'missing'
UNION ALL SELECT 'orders', count(*), 'loaded' FROM dirty_orders
UNION ALL SELECT 'order_items', count(*), 'loaded' FROM dirty_items
UNION ALL SELECT 'all raw tables', NULL, 'PATH_NOT_FOUND'"""),
    "f18_argument_dates": _shop("""
, months AS (
  SELECT DISTINCT date_trunc('month', order_date) AS day FROM shop_orders WHERE order_date IS NOT NULL
)
SELECT strftime(day, '%Y-%m-%d') AS argument, true AS accepted FROM months
UNION ALL SELECT strftime(day, '%d-%m-%Y'), false FROM months
UNION ALL SELECT strftime(day, '%Y-%m'), false FROM months"""),
}

ORACLE_SQL["r05_all_grains"] = " UNION ALL ".join(
    f"SELECT '{grain}' AS grain, * FROM ({ORACLE_SQL[f'r05_{grain}_report']})" for grain in ("day", "week", "month")
)
