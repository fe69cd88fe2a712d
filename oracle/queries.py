"""One SQL text per registered query."""

from __future__ import annotations

from oracle.base import (
    CUTOFF,
    PANEL_180,
    PANEL_365,
    PANEL_ALL,
    PANEL_COLUMNS,
    PANEL_EVERY,
    SNAPSHOTS,
    dbl,
    days,
    rfm_case,
    rnd,
    with_parts,
)
from oracle.values import FEATURES, HIGH_VALUE_TERMS, PLAYS, RFM_NTILE_RULES, RFM_RULES, RFM_SHORT_RULES, evenly

SALE = "o.order_status NOT IN ('canceled','unavailable')"
LEGACY = "o.order_status NOT IN ('cancelled')"
NET = "(i.price * i.quantity - i.discount_amount)"
RATE = "CAST(CAST(i.discount_amount AS DOUBLE) / (CAST(i.price AS DOUBLE) * i.quantity + 0.0001) AS DECIMAL(18,10))"
MONTH = "strftime(o.order_purchase_timestamp, '%Y-%m')"

SQL: dict[str, str] = {}


def q(name: str, needs: list[str], body: str) -> None:
    SQL[name] = with_parts(needs, body)


def _growth(inner: str, extra: str) -> str:
    return f"""SELECT order_month, total_orders, unique_customers, {extra} net_revenue,
  lag(net_revenue) OVER (ORDER BY order_month) AS prev_month_revenue,
  {rnd('(net_revenue - lag(net_revenue) OVER (ORDER BY order_month)) / nullif(lag(net_revenue) OVER (ORDER BY order_month), 0) * 100.0', 2)} AS mom_growth_pct
FROM ({inner}) m"""


q(
    "monthly_revenue",
    ["fact_orders", "fact_order_items", "dim_customers"],
    _growth(
        f"""SELECT {MONTH} AS order_month, count(DISTINCT o.order_id) AS total_orders,
  count(DISTINCT c.customer_unique_id) AS unique_customers, {rnd('sum(i.price)', 2)} AS item_revenue,
  {rnd('sum(i.price + i.freight_value)', 2)} AS net_revenue
FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
JOIN fact_order_items i ON o.order_id = i.order_id WHERE {SALE} GROUP BY 1""",
        "item_revenue,",
    ),
)
q(
    "monthly_revenue_net",
    ["fact_orders", "fact_order_items"],
    _growth(
        f"""SELECT {MONTH} AS order_month, count(DISTINCT o.order_id) AS total_orders,
  count(DISTINCT o.customer_id) AS unique_customers, {rnd(f'sum({NET})', 2)} AS net_revenue
FROM fact_orders o JOIN fact_order_items i ON o.order_id = i.order_id WHERE {LEGACY} GROUP BY 1""",
        "",
    ),
)
q(
    "eda_monthly",
    ["fact_orders", "fact_order_items"],
    f"""SELECT {MONTH} AS month, {rnd('sum(i.price)', 2)} AS revenue, count(DISTINCT o.order_id) AS orders
FROM fact_orders o JOIN fact_order_items i ON o.order_id = i.order_id WHERE {LEGACY} GROUP BY 1""",
)
q(
    "category_performance",
    ["fact_orders", "fact_order_items", "dim_products"],
    f"""SELECT *, {rnd('category_revenue / sum(category_revenue) OVER () * 100.0', 2)} AS revenue_share_pct,
  dense_rank() OVER (ORDER BY category_revenue DESC) AS revenue_rank
FROM (SELECT COALESCE(p.product_category_name_english, 'unknown_category') AS category_name,
  count(DISTINCT i.order_id) AS orders_count, count(i.order_item_id) AS units_sold,
  {rnd('sum(i.price)', 2)} AS category_revenue,
  {rnd(f"{dbl('sum(i.price)')} / count(i.price)", 2)} AS avg_item_price,
  {rnd(f"{dbl('sum(i.freight_value)')} / count(i.freight_value)", 2)} AS avg_freight
FROM fact_order_items i JOIN dim_products p ON i.product_id = p.product_id
JOIN fact_orders o ON i.order_id = o.order_id WHERE {SALE} GROUP BY 1) c""",
)
q(
    "category_discount",
    ["fact_orders", "fact_order_items", "dim_products"],
    f"""SELECT *, {rnd('category_revenue / sum(category_revenue) OVER () * 100.0', 2)} AS revenue_share_pct,
  dense_rank() OVER (ORDER BY category_revenue DESC) AS revenue_rank
FROM (SELECT p.product_category_name_english AS category_name, count(DISTINCT i.order_id) AS orders_count,
  CAST(sum(i.quantity) AS BIGINT) AS units_sold, {rnd(f'sum({NET})', 2)} AS category_revenue,
  {rnd(f"{dbl(f'sum({RATE})')} / count({RATE}) * 100.0", 2)} AS avg_discount_pct
FROM fact_order_items i JOIN dim_products p ON i.product_id = p.product_id
JOIN fact_orders o ON i.order_id = o.order_id WHERE {LEGACY} GROUP BY 1) c""",
)
q(
    "eda_categories",
    ["fact_order_items", "dim_products"],
    f"""SELECT p.product_category_name_english, {rnd('sum(i.price)', 2)} AS category_revenue,
  count(i.order_item_id) AS total_units, {rnd(f"{dbl(f'sum({RATE})')} / count({RATE}) * 100.0", 2)} AS avg_discount_pct
FROM fact_order_items i JOIN dim_products p ON i.product_id = p.product_id GROUP BY 1""",
)
q(
    "top_customers",
    ["fact_orders", "fact_order_items", "dim_customers"],
    f"""SELECT *, dense_rank() OVER (ORDER BY total_spend DESC) AS customer_rank
FROM (SELECT c.customer_unique_id, c.customer_state, c.customer_city, count(DISTINCT o.order_id) AS total_orders,
  count(i.order_item_id) AS total_items, {rnd('sum(i.price)', 2)} AS total_spend,
  {rnd(f"{dbl('sum(i.price)')} / count(i.price)", 2)} AS avg_item_spend
FROM dim_customers c JOIN fact_orders o ON c.customer_id = o.customer_id
JOIN fact_order_items i ON o.order_id = i.order_id WHERE {SALE} GROUP BY 1, 2, 3) t
ORDER BY total_spend DESC, customer_unique_id, customer_state, customer_city LIMIT 25""",
)
q(
    "top_customers_net",
    ["fact_orders", "fact_order_items", "dim_customers"],
    f"""SELECT *, dense_rank() OVER (ORDER BY total_spent DESC) AS customer_rank
FROM (SELECT c.customer_id, c.customer_city, c.customer_state, count(DISTINCT o.order_id) AS lifetime_orders,
  {rnd(f'sum({NET})', 2)} AS total_spent, {rnd(f"{dbl(f'sum({NET})')} / count({NET})", 2)} AS avg_spend_per_order
FROM dim_customers c JOIN fact_orders o ON c.customer_id = o.customer_id
JOIN fact_order_items i ON o.order_id = i.order_id WHERE {LEGACY} GROUP BY 1, 2, 3) t
ORDER BY total_spent DESC, customer_id LIMIT 10""",
)


def _spend(amount: str, customer: str, where: str) -> str:
    return f"""SELECT c.{customer}, ROUND(sum({amount}), 2) AS total_spend, count(DISTINCT o.order_id) AS order_count
FROM dim_customers c JOIN fact_orders o ON c.customer_id = o.customer_id
JOIN fact_order_items i ON o.order_id = i.order_id WHERE {where} GROUP BY 1"""


def _quartiles(amount: str, customer: str, where: str) -> str:
    return f"""SELECT spend_quartile, count({customer}) AS customer_count, {rnd('sum(total_spend)', 2)} AS group_total_spend,
  {rnd(f"{dbl('sum(total_spend)')} / count(total_spend)", 2)} AS group_avg_spend,
  {rnd(f"{dbl('sum(order_count)')} / count(order_count)", 2)} AS group_avg_orders
FROM (SELECT *, ntile(4) OVER (ORDER BY total_spend DESC, {customer}) AS spend_quartile
      FROM ({_spend(amount, customer, where)}) s) t GROUP BY 1"""


BOTH = ["fact_orders", "fact_order_items", "dim_customers"]
q("spend_quartiles", BOTH, _quartiles("i.price", "customer_unique_id", SALE))
q("spend_quartiles_net", BOTH, _quartiles(NET, "customer_id", LEGACY))
q(
    "pareto_share",
    BOTH,
    f"""SELECT count(*) AS customers, count(CASE WHEN rk <= floor(n * 0.15) THEN 1 END) AS top_customers,
  {dbl('sum(total_spend)')} AS total_revenue,
  {dbl('sum(CASE WHEN rk <= floor(n * 0.15) THEN total_spend END)')} AS top_revenue,
  {rnd(f"{dbl('sum(CASE WHEN rk <= floor(n * 0.15) THEN total_spend END)')} / {dbl('sum(total_spend)')} * 100.0", 2)} AS top_share_pct
FROM (SELECT *, row_number() OVER (ORDER BY total_spend DESC, customer_unique_id) AS rk, count(*) OVER () AS n
      FROM ({_spend('i.price', 'customer_unique_id', SALE)}) s) t""",
)

_GAPS = """SELECT {cust}, count(*) AS repeat_orders_count,
  {avg} AS avg_days_between_orders, CAST(min(gap) AS DOUBLE) AS min_days_between_orders,
  CAST(max(gap) AS DOUBLE) AS max_days_between_orders
FROM (SELECT {cust}, ROUND(CAST({gap} AS DECIMAL(28,8)), 1) AS gap FROM (
  SELECT {cust}, {ts} AS ts, lag({ts}) OVER (PARTITION BY {cust} ORDER BY {ts}) AS prev FROM {src}) l
  WHERE prev IS NOT NULL) g GROUP BY 1 ORDER BY repeat_orders_count DESC, {cust} LIMIT 15"""
q(
    "purchase_gaps",
    ["fact_orders"],
    _GAPS.format(
        cust="customer_id",
        ts="order_purchase_timestamp",
        src="fact_orders o WHERE " + LEGACY,
        gap=days("prev", "ts"),
        avg=rnd("CAST(sum(gap) AS DOUBLE) / count(gap)", 1),
    ),
)
q(
    "event_gaps",
    [],
    _GAPS.format(
        cust="user_id",
        ts="ts",
        src="events",
        gap=days("prev", "ts"),
        avg=rnd("CAST(sum(gap) AS DOUBLE) / count(gap)", 1),
    ),
)

_COHORT = f"""(SELECT a.cohort_month, z.cohort_size, CAST(a.cohort_index AS BIGINT) AS cohort_index, a.active_customers,
  {rnd('CAST(a.active_customers AS DOUBLE) / z.cohort_size * 100.0', 2)} AS retention_rate_pct
FROM (SELECT strftime(f.first_ts, '%Y-%m') AS cohort_month,
        (year(s.ts) - year(f.first_ts)) * 12 + month(s.ts) - month(f.first_ts) AS cohort_index,
        count(DISTINCT s.cust) AS active_customers
      FROM sold s JOIN (SELECT cust, min(ts) AS first_ts FROM sold GROUP BY cust) f ON s.cust = f.cust GROUP BY 1, 2) a
JOIN (SELECT strftime(first_ts, '%Y-%m') AS cohort_month, count(DISTINCT cust) AS cohort_size
      FROM (SELECT cust, min(ts) AS first_ts FROM sold GROUP BY cust) f GROUP BY 1) z ON a.cohort_month = z.cohort_month
WHERE a.cohort_index BETWEEN 0 AND 12)"""
_SOLD = f""", sold AS (SELECT c.customer_unique_id AS cust, o.order_purchase_timestamp AS ts
FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id WHERE {SALE})"""
_SOLD_LEGACY = f""", sold AS (SELECT o.customer_id AS cust, o.order_purchase_timestamp AS ts FROM fact_orders o WHERE {LEGACY})"""
q("cohort_retention", ["fact_orders", "dim_customers"], _SOLD + f"\nSELECT * FROM {_COHORT} r")
q("cohort_retention_legacy", ["fact_orders"], _SOLD_LEGACY + f"\nSELECT * FROM {_COHORT} r")
q(
    "cohort_matrix",
    ["fact_orders", "dim_customers"],
    _SOLD
    + "\nSELECT cohort_month, cohort_size, "
    + ", ".join(f"max(CASE WHEN cohort_index = {i} THEN retention_rate_pct END) AS m{i}" for i in range(13))
    + f" FROM {_COHORT} r GROUP BY 1, 2",
)

# -- RFM ---------------------------------------------------------------------
_RFM = "customer_unique_id, latest_order, frequency, monetary, recency, r_score, f_score, m_score, r_score * 100 + f_score * 10 + m_score AS rfm_score"
q("rfm", ["rfm_scored"], f"SELECT {_RFM}, {rfm_case(RFM_RULES)} AS rfm_segment FROM rfm_scored")
q("rfm_short_rules", ["rfm_scored"], f"SELECT {_RFM}, {rfm_case(RFM_SHORT_RULES)} AS rfm_segment FROM rfm_scored")
q(
    "rfm_ntile",
    BOTH,
    f"""SELECT *, r_score * 100 + f_score * 10 + m_score AS rfm_score, {rfm_case(RFM_NTILE_RULES)} AS rfm_segment FROM (
SELECT customer_id, recency, frequency, monetary,
  CAST(ntile(5) OVER (ORDER BY recency DESC, customer_id) AS INT) AS r_score,
  CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INT) AS f_score,
  CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INT) AS m_score FROM (
SELECT c.customer_id, count(DISTINCT o.order_id) AS frequency, {rnd(f'sum({NET})', 2)} AS monetary,
  CAST({rnd(days('max(o.order_purchase_timestamp)', f"TIMESTAMP '{CUTOFF}'"), 0)} AS INT) AS recency
FROM dim_customers c JOIN fact_orders o ON c.customer_id = o.customer_id
JOIN fact_order_items i ON o.order_id = i.order_id
WHERE o.order_purchase_timestamp < TIMESTAMP '{CUTOFF}' AND {LEGACY} GROUP BY 1) v) s""",
)
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS measure, CAST({c} AS DOUBLE) AS v FROM rfm_values" for c in ("recency", "frequency", "monetary")
)
q(
    "rfm_describe",
    ["rfm_values"],
    f"""SELECT measure, count(v) AS count, {rnd('avg(v)', 4)} AS mean, {rnd('stddev_samp(v)', 4)} AS std, min(v) AS min,
  {rnd('quantile_cont(v, 0.25)', 4)} AS p25, {rnd('quantile_cont(v, 0.5)', 4)} AS p50, {rnd('quantile_cont(v, 0.75)', 4)} AS p75,
  max(v) AS max FROM ({_LONG}) l GROUP BY measure""",
)

# -- cleaning ----------------------------------------------------------------
TITLE = (
    "array_to_string(list_transform(regexp_extract_all({s}, '([[:alpha:]]+|[^[:alpha:]]+)'), "
    "lambda x: upper(x[1]) || lower(x[2:])), '')"
)


def title(expr: str) -> str:
    return TITLE.format(s=f"trim({expr})")


q(
    "clean_lookup",
    ["dim_category_translation"],
    """SELECT product_category_name, product_category_name_english FROM dim_category_translation
UNION ALL SELECT * FROM (VALUES ('pc_gamer', 'pc_gamer'),
 ('portateis_cozinha_e_preparadores_de_alimentos', 'small_appliances_kitchen_and_food_preparers'),
 ('unknown_category', 'unknown_category')) v""",
)
q(
    "clean_products",
    ["dim_category_translation"],
    """SELECT p_partkey AS product_id, COALESCE(raw.cat, 'unknown_category') AS product_category_name,
  p_size AS product_name_length, COALESCE(t.product_category_name_english, 'unknown_category') AS product_category_name_english
FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS cat FROM part) raw
LEFT JOIN dim_category_translation t ON raw.cat = t.product_category_name""",
)
q(
    "clean_geo",
    ["geolocation"],
    f"""SELECT m.geolocation_zip_code_prefix, m.latitude, m.longitude, {title('c.v')} AS city, upper(trim(s.v)) AS state
FROM (SELECT geolocation_zip_code_prefix, CAST(sum(geolocation_lat) AS DOUBLE) / count(geolocation_lat) AS latitude,
        CAST(sum(geolocation_lng) AS DOUBLE) / count(geolocation_lng) AS longitude FROM geolocation GROUP BY 1) m
JOIN (SELECT geolocation_zip_code_prefix AS z, geolocation_city AS v,
        row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY count(*) DESC, geolocation_city) AS rk
      FROM geolocation GROUP BY 1, 2) c ON c.z = m.geolocation_zip_code_prefix AND c.rk = 1
JOIN (SELECT geolocation_zip_code_prefix AS z, geolocation_state AS v,
        row_number() OVER (PARTITION BY geolocation_zip_code_prefix ORDER BY count(*) DESC, geolocation_state) AS rk
      FROM geolocation GROUP BY 1, 2) s ON s.z = m.geolocation_zip_code_prefix AND s.rk = 1""",
)
q(
    "clean_locations",
    [],
    f"""SELECT 'customer' AS kind, c_custkey AS id, {title("'  ' || lower(c_mktsegment) || '-d''oeste '")} AS city,
  upper(trim('  ' || lower(n_name) || ' ')) AS state FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'seller', s_suppkey, {title("'  ' || lower(n_name) || ' do sul'")}, upper(trim(lower(n_name) || ' '))
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
q(
    "clean_orders",
    [],
    """SELECT o_orderkey AS order_id, TRY_CAST(CASE WHEN o_orderkey % 97 = 0 THEN 'unknown'
  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS order_purchase_timestamp,
  TRY_CAST(CASE WHEN o_orderkey % 89 = 0 THEN '2001-13-45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS TIMESTAMP)
  AS order_approved_at FROM orders""",
)
q(
    "clean_reviews",
    [],
    """SELECT doc_id AS review_id, CAST(1 + doc_id % 5 AS INT) AS review_score, COALESCE(lang, '') AS review_comment_title,
  COALESCE(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE text END, '') AS review_comment_message FROM documents""",
)
q(
    "clean_payments",
    ["fact_order_payments"],
    "SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM fact_order_payments",
)
q(
    "remediate_items",
    ["fact_orders", "fact_order_items", "dim_products"],
    """SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value, quantity, discount_amount
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
        ORDER BY product_id, seller_id, shipping_limit_date, price, freight_value, quantity, discount_amount) AS rk
      FROM fact_order_items) i
WHERE rk = 1 AND price > 0 AND quantity > 0 AND order_id IN (SELECT order_id FROM fact_orders)
  AND product_id IN (SELECT product_id FROM dim_products)""",
)
q(
    "remediate_orders",
    ["fact_order_items", "fact_orders", "dim_customers"],
    """SELECT order_id, customer_id, order_purchase_timestamp,
  CASE WHEN shipped >= order_purchase_timestamp THEN shipped END AS order_delivered_customer_date
FROM (SELECT o.order_id, CASE WHEN o.order_id % 11 = 0 THEN -o.order_id ELSE o.customer_id END AS customer_id,
        o.order_purchase_timestamp, min(i.shipping_limit_date) AS shipped
      FROM fact_orders o JOIN fact_order_items i ON o.order_id = i.order_id GROUP BY 1, 2, 3) x
WHERE customer_id IN (SELECT customer_id FROM dim_customers)""",
)

# -- data quality ------------------------------------------------------------
ROLE_KEYS = {
    "dim_category_translation": ["product_category_name"],
    "dim_products": ["product_id"],
    "dim_geolocation": ["geolocation_zip_code_prefix"],
    "dim_customers": ["customer_id"],
    "dim_sellers": ["seller_id"],
    "fact_orders": ["order_id"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_order_payments": ["order_id", "payment_sequential"],
    "fact_order_reviews": ["review_id", "order_id"],
}
ROLES = list(ROLE_KEYS)
REFS = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
    ("fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("fact_order_payments", "order_id", "fact_orders", "order_id"),
    ("fact_order_reviews", "order_id", "fact_orders", "order_id"),
]
MINIMUMS = {
    "dim_category_translation": 70,
    "dim_products": 30000,
    "dim_geolocation": 15000,
    "dim_customers": 90000,
    "dim_sellers": 3000,
    "fact_orders": 90000,
    "fact_order_items": 100000,
    "fact_order_payments": 100000,
    "fact_order_reviews": 90000,
}
_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({MINIMUMS[t]} AS BIGINT) AS minimum_rows FROM {t}" for t in ROLES
)
q("dq_row_counts", ROLES, f"SELECT *, CASE WHEN row_count >= minimum_rows THEN 1 ELSE 0 END AS ok FROM ({_COUNTS}) c")


def _keys(table: str, cols: list[str], source: str | None = None) -> str:
    any_null = " OR ".join(f"{c} IS NULL" for c in cols)
    return f"""SELECT '{table}' AS table_name, CAST(COALESCE(sum(copies - 1), 0) AS BIGINT) AS duplicate_rows,
  CAST(COALESCE(sum(CASE WHEN {any_null} THEN copies END), 0) AS BIGINT) AS null_rows
FROM (SELECT {', '.join(cols)}, count(*) AS copies FROM {source or table} GROUP BY {', '.join(cols)}) k"""


_PK = " UNION ALL ".join(_keys(t, c) for t, c in ROLE_KEYS.items())
q("dq_primary_keys", ROLES, _PK)

# more references, some of which do not hold; the last child key is often NULL
EXTRA_REFS = [
    ("events", "user_id", "dim_customers", "customer_id"),
    ("dim_customers", "customer_id", "fact_orders", "customer_id"),
    ("dim_products", "product_id", "fact_order_items", "product_id"),
    ("embeddings", "vec_id", "documents", "doc_id"),
    ("fact_orders", "order_delivered_customer_date", "fact_orders", "order_purchase_timestamp"),
]


def _orphans(null_counts: bool, refs: list[tuple[str, str, str, str]]) -> str:
    texts = []
    for child, col, parent, key in refs:
        extra = "" if null_counts else f" AND c.{col} IS NOT NULL"
        texts.append(
            f"SELECT '{child}.{col} -> {parent}.{key}' AS reference, count(*) AS orphan_count FROM {child} c "
            f"LEFT JOIN (SELECT DISTINCT {key} FROM {parent}) p ON c.{col} = p.{key} WHERE p.{key} IS NULL{extra}"
        )
    return " UNION ALL ".join(texts)


q("dq_orphans", ROLES, _orphans(False, REFS + EXTRA_REFS))
q("dq_orphans_sql", ROLES, _orphans(True, REFS + EXTRA_REFS))
q(
    "load_report",
    ROLES,
    "SELECT 'rows' AS \"check\", table_name AS subject, row_count AS n FROM ("
    + _COUNTS
    + ") c UNION ALL SELECT 'rows', 'total', CAST(sum(row_count) AS BIGINT) FROM ("
    + _COUNTS
    + ") c UNION ALL SELECT 'orphans', reference, orphan_count FROM ("
    + _orphans(True, REFS)
    + ") o",
)
_MONEY = """SELECT 'negative_price' AS check_name, count(CASE WHEN price < 0 THEN 1 END) AS row_count FROM fact_order_items
UNION ALL SELECT 'negative_freight', count(CASE WHEN freight_value < 0 THEN 1 END) FROM fact_order_items
UNION ALL SELECT 'negative_payment', count(CASE WHEN payment_value < 0 THEN 1 END) FROM fact_order_payments
UNION ALL SELECT 'zero_payment', count(CASE WHEN payment_value = 0 THEN 1 END) FROM fact_order_payments"""
q("dq_money", ["fact_order_items", "fact_order_payments"], _MONEY)
q(
    "dq_time",
    ["fact_orders", "fact_order_items"],
    """SELECT 'missing_start' AS check_name, count(CASE WHEN o.order_purchase_timestamp IS NULL THEN 1 END) AS row_count
FROM fact_order_items i LEFT JOIN fact_orders o ON i.order_id = o.order_id AND o.order_status <> 'unavailable'
UNION ALL SELECT 'end_before_start', count(CASE WHEN i.shipping_limit_date < o.order_purchase_timestamp THEN 1 END)
FROM fact_order_items i LEFT JOIN fact_orders o ON i.order_id = o.order_id AND o.order_status <> 'unavailable'""",
)
_TIME = """SELECT 'missing_start' AS check_name, count(CASE WHEN order_purchase_timestamp IS NULL THEN 1 END) AS row_count FROM fact_orders
UNION ALL SELECT 'end_before_start', count(CASE WHEN order_delivered_customer_date < order_purchase_timestamp THEN 1 END) FROM fact_orders"""
q(
    "dq_suite",
    ROLES,
    f"""SELECT check_name, subject, row_count, CASE WHEN row_count = 0 THEN 'ok'
  WHEN check_name IN ('zero_payment', 'end_before_start') THEN 'warning' ELSE 'error' END AS severity FROM (
SELECT 'row_count' AS check_name, table_name AS subject, greatest(minimum_rows - row_count, 0) AS row_count FROM ({_COUNTS}) c
UNION ALL SELECT 'duplicate_key', table_name, duplicate_rows FROM ({_PK}) k
UNION ALL SELECT 'null_key', table_name, null_rows FROM ({_PK}) k
UNION ALL SELECT 'orphan', reference, orphan_count FROM ({_orphans(False, REFS)}) o
UNION ALL SELECT check_name, 'money', row_count FROM ({_MONEY}) m
UNION ALL SELECT check_name, 'fact_orders', row_count FROM ({_TIME}) t) s""",
)
_ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
q(
    "dq_nulls",
    ["fact_orders"],
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM fact_orders" for c in _ORDER_COLUMNS
    ),
)
q(
    "dq_items",
    ["fact_order_items"],
    f"""SELECT 'null_cells' AS check_name, {' + '.join(f'count(*) - count({c})' for c in (
        'order_id', 'order_item_id', 'product_id', 'seller_id', 'shipping_limit_date', 'price', 'freight_value', 'quantity', 'discount_amount'))} AS row_count
FROM fact_order_items
UNION ALL SELECT 'duplicate_items', duplicate_rows FROM ({_keys('i', ['order_id', 'order_item_id'], 'fact_order_items')}) k
UNION ALL SELECT 'non_positive_quantity', count(CASE WHEN quantity <= 0 THEN 1 END) FROM fact_order_items
UNION ALL SELECT 'non_positive_price', count(CASE WHEN price <= 0 THEN 1 END) FROM fact_order_items""",
)

# -- panels ------------------------------------------------------------------
q("churn_panel", [PANEL_ALL], f"SELECT {PANEL_COLUMNS} FROM {PANEL_ALL}")
q("churn_panel_180", [PANEL_180], f"SELECT {PANEL_COLUMNS} FROM {PANEL_180}")
q("churn_panel_365", [PANEL_365], f"SELECT {PANEL_COLUMNS} FROM {PANEL_365}")
q(
    "panel_extras",
    [PANEL_ALL],
    f"""SELECT customer_unique_id, snapshot_date AS snapshot_id, max_order_value, items_per_order, avg_item_price, pct_boleto,
  pct_voucher, late_delivery_count, customer_lifetime_days FROM {PANEL_ALL}""",
)
_ROLE_COLUMNS = ", ".join(
    f"""count(CASE WHEN split_role = '{r}' THEN 1 END) AS {r}_obs,
  count(CASE WHEN split_role = '{r}' AND is_churned = 0 THEN 1 END) AS {r}_retained,
  {rnd(f"count(CASE WHEN split_role = '{r}' AND is_churned = 1 THEN 1 END) * 1.0 / nullif(count(CASE WHEN split_role = '{r}' THEN 1 END), 0) * 100.0", 2)} AS {r}_churn_pct"""
    for r in ("train", "val", "test")
)
q(
    "lookback_compare",
    [PANEL_EVERY],
    f"""SELECT *, max(total_panel_obs) FILTER (lookback = 'all') OVER () - total_panel_obs AS observations_lost,
  max(unique_customers) FILTER (lookback = 'all') OVER () - unique_customers AS customers_dropped
FROM (SELECT COALESCE(CAST(lookback_days AS VARCHAR), 'all') AS lookback, count(*) AS total_panel_obs,
  count(DISTINCT customer_unique_id) AS unique_customers, {_ROLE_COLUMNS}
FROM {PANEL_EVERY} GROUP BY 1) t""",
)
_RATES = f"""count(*) AS observations, CAST(count(*) - sum(is_churned) AS BIGINT) AS retained, CAST(sum(is_churned) AS BIGINT) AS churned,
  {rnd('CAST(sum(is_churned) AS DOUBLE) / count(*) * 100.0', 2)} AS churn_rate_pct,
  {rnd('100.0 - CAST(sum(is_churned) AS DOUBLE) / count(*) * 100.0', 2)} AS retention_rate_pct"""
q(
    "target_report",
    [PANEL_ALL],
    f"""SELECT 'snapshot' AS scope, snapshot_date AS name, {_RATES} FROM {PANEL_ALL} GROUP BY snapshot_date
UNION ALL SELECT 'split', split_role, {_RATES} FROM {PANEL_ALL} GROUP BY split_role
UNION ALL SELECT 'overall', 'all', {_RATES} FROM {PANEL_ALL}""",
)
q(
    "snapshot_frequency",
    [PANEL_ALL],
    f"""SELECT snapshots, count(*) AS customers FROM (SELECT customer_unique_id, count(snapshot_date) AS snapshots
FROM {PANEL_ALL} GROUP BY 1) t GROUP BY 1""",
)
q(
    "leakage_audit",
    [PANEL_EVERY],
    """SELECT s.snapshot_date, s.lookback_days, max(o.order_purchase_timestamp) AS max_purchase_timestamp,
  max(CASE WHEN o.order_purchase_timestamp >= s.snap THEN 1 ELSE 0 END) AS future_purchase_detected,
  count(CASE WHEN o.order_delivered_customer_date >= s.snap THEN 1 END) AS clamped_future_deliveries
FROM fact_orders o JOIN pe_snaps s ON o.order_purchase_timestamp < s.snap
  AND (s.low IS NULL OR o.order_purchase_timestamp >= s.low) GROUP BY 1, 2""",
)
_FEATURE_LONG = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {PANEL_ALL}" for f in FEATURES)
q(
    "feature_stats",
    [PANEL_ALL],
    f"""SELECT feature, {rnd('avg(v)', 4)} AS mean, {rnd('stddev_samp(v)', 4)} AS std, {rnd('quantile_cont(v, 0.5)', 4)} AS median,
  {rnd('min(v)', 4)} AS min, {rnd('max(v)', 4)} AS max,
  {rnd('CAST(count(CASE WHEN v = 0 THEN 1 END) AS DOUBLE) / count(*) * 100.0', 2)} AS zero_pct
FROM ({_FEATURE_LONG}) l GROUP BY feature""",
)
q(
    "feature_nulls",
    [PANEL_ALL],
    " UNION ALL ".join(f"SELECT '{f}' AS column_name, count(*) - count({f}) AS null_count FROM {PANEL_ALL}" for f in FEATURES),
)
_CHURN = f"""count(*) AS observations, CAST(sum(is_churned) AS BIGINT) AS churned,
  {rnd('CAST(sum(is_churned) AS DOUBLE) / count(*) * 100.0', 2)} AS churn_rate_pct"""
q(
    "delay_churn",
    [PANEL_ALL],
    f"SELECT CASE WHEN avg_delivery_delay_days > 3.0 THEN 1 ELSE 0 END AS late, {_CHURN} FROM {PANEL_ALL} GROUP BY 1",
)
q(
    "dormancy",
    [PANEL_ALL],
    f""", ranked AS (SELECT c.customer_unique_id, o.order_purchase_timestamp AS ts,
    row_number() OVER (PARTITION BY c.customer_unique_id ORDER BY o.order_purchase_timestamp, o.order_id) AS rk,
    lead(o.order_purchase_timestamp) OVER (PARTITION BY c.customer_unique_id ORDER BY o.order_purchase_timestamp, o.order_id) AS nxt
  FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id)
SELECT CASE WHEN r.nxt IS NOT NULL AND {days('r.ts', 'r.nxt')} <= 60 AND r.nxt < CAST(p.snapshot_date AS TIMESTAMP)
  THEN 1 ELSE 0 END AS has_second_order, {_CHURN}
FROM {PANEL_ALL} p JOIN ranked r ON p.customer_unique_id = r.customer_unique_id AND r.rk = 1
WHERE r.ts + to_days(60) <= CAST(p.snapshot_date AS TIMESTAMP) GROUP BY 1""",
)
q(
    "split_sizes",
    [PANEL_ALL],
    f"SELECT split_role, count(*) AS n, CAST(sum(is_churned) AS BIGINT) AS churned FROM {PANEL_ALL} GROUP BY 1",
)
q(
    "panel_sql",
    ["fact_orders"],
    f"""SELECT order_status, count(*) AS orders FROM fact_orders
WHERE order_purchase_timestamp < TIMESTAMP '{CUTOFF}' GROUP BY order_status""",
)
SNAPSHOT_DATES = [d for _, d, _ in SNAPSHOTS]


# -- metrics and thresholds --------------------------------------------------
GRID50 = evenly(0.10, 0.95, 50)
GRID20 = evenly(0.15, 0.85, 20)


def _values(grid: list[float], name: str) -> str:
    rows = ", ".join(f"(CAST({g!r} AS DOUBLE))" for g in grid)
    return f"(VALUES {rows}) {name}(th)"


def _confusion(pred: str) -> str:
    return f"""count(CASE WHEN is_churned = 0 AND NOT ({pred}) THEN 1 END) AS true_negatives,
  count(CASE WHEN is_churned = 0 AND {pred} THEN 1 END) AS false_positives,
  count(CASE WHEN is_churned = 1 AND NOT ({pred}) THEN 1 END) AS false_negatives,
  count(CASE WHEN is_churned = 1 AND {pred} THEN 1 END) AS true_positives"""


PRECISION = "COALESCE(CAST(true_positives AS DOUBLE) / nullif(true_positives + false_positives, 0), 0.0)"
RECALL = "COALESCE(CAST(true_positives AS DOUBLE) / nullif(true_positives + false_negatives, 0), 0.0)"
F1 = "COALESCE(CAST(2 * true_positives AS DOUBLE) / nullif(2 * true_positives + false_positives + false_negatives, 0), 0.0)"
SPECIFICITY = "COALESCE(CAST(true_negatives AS DOUBLE) / nullif(true_negatives + false_positives, 0), 0.0)"
q(
    "metrics",
    ["curve"],
    f"""SELECT c.split_role, {rnd('CAST(true_positives + true_negatives AS DOUBLE) / (true_positives + true_negatives + false_positives + false_negatives)', 8)} AS accuracy,
  {rnd(PRECISION, 8)} AS precision, {rnd(RECALL, 8)} AS recall, {rnd(F1, 8)} AS f1_score, {rnd('roc_auc', 8)} AS roc_auc,
  {rnd('pr_auc', 8)} AS pr_auc, {rnd('brier_score', 8)} AS brier_score, true_negatives, false_positives, false_negatives,
  true_positives, {rnd(SPECIFICITY, 8)} AS specificity
FROM (SELECT split_role, {_confusion('p >= 0.5')}, avg((p - is_churned) * (p - is_churned)) AS brier_score FROM scored GROUP BY 1) c
JOIN (SELECT split_role, sum(CAST(neg AS DOUBLE) * (tp - pos / 2.0)) / (max(all_pos) * CAST(max(all_neg) AS DOUBLE)) AS roc_auc,
        sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / max(all_pos) AS pr_auc FROM curve GROUP BY 1) a ON a.split_role = c.split_role""",
)
q(
    "roc_points",
    ["curve"],
    """SELECT split_role, p AS threshold, CAST(fp AS DOUBLE) / CAST(all_neg AS DOUBLE) AS fpr,
  CAST(tp AS DOUBLE) / CAST(all_pos AS DOUBLE) AS tpr FROM curve""",
)
q(
    "pr_points",
    ["curve"],
    """SELECT split_role, p AS threshold, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
  CAST(tp AS DOUBLE) / CAST(all_pos AS DOUBLE) AS recall FROM curve""",
)
q(
    "confusion_table",
    ["scored"],
    """SELECT a.v AS actual, b.v AS predicted,
  (SELECT count(*) FROM scored WHERE is_churned = a.v AND (CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) = b.v) AS n
FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v)""",
)


def _sweep(where: str) -> str:
    return f"""SELECT {rnd('th', 3)} AS threshold, {rnd(PRECISION, 4)} AS precision, {rnd(RECALL, 4)} AS recall, {rnd(F1, 4)} AS f1_score,
  true_positives, false_positives, true_negatives, false_negatives,
  CAST(false_positives * 10.0 + false_negatives * 120.0 AS DOUBLE) AS total_business_cost,
  true_positives + false_positives AS targeted_customers, CAST((true_positives + false_positives) * 10.0 AS DOUBLE) AS campaign_cost,
  CAST(floor((true_positives + false_positives) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS expected_saved_customers,
  CAST(floor((true_positives + false_positives) * CAST(0.2 AS DOUBLE)) * 120.0 - (true_positives + false_positives) * 10.0 AS DOUBLE) AS net_saved_value
FROM (SELECT th, {_confusion('p >= th')} FROM scored CROSS JOIN {_values(GRID50, 'g')} {where} GROUP BY th) s"""


q("threshold_sweep", ["scored"], _sweep(""))
_AT = f"""SELECT '{{name}}' AS choice, threshold, {rnd(PRECISION, 4)} AS precision, {rnd(RECALL, 4)} AS recall, {rnd(F1, 4)} AS f1_score,
  true_positives, false_positives, true_negatives, false_negatives,
  CAST(false_positives * 10.0 + false_negatives * 120.0 AS DOUBLE) AS total_business_cost,
  CAST((false_positives + true_negatives) * 10.0 AS DOUBLE) AS target_all_cost
FROM (SELECT t.threshold, {_confusion('p >= t.threshold')} FROM scored CROSS JOIN {{source}} t WHERE split_role = 'test' GROUP BY 1) s"""
q(
    "frozen_threshold",
    ["scored"],
    ", best AS (SELECT threshold, total_business_cost FROM ("
    + _sweep("WHERE split_role = 'val'")
    + ") s ORDER BY total_business_cost, threshold LIMIT 1), both_choices AS ("
    + _AT.format(name="frozen", source="best")
    + " UNION ALL "
    + _AT.format(name="default", source="(SELECT CAST(0.5 AS DOUBLE) AS threshold)")
    + f""") SELECT b.*, (SELECT total_business_cost FROM best) AS validation_cost,
  {rnd("(d.total_business_cost - b.total_business_cost) / greatest(d.total_business_cost, 1.0) * 100.0", 2)} AS cost_reduction_pct
FROM both_choices b JOIN both_choices d ON d.choice = 'default'""",
)
_TARGETED = "count(CASE WHEN churn_probability >= {th} THEN 1 END)"
_SAVED = "floor(targeted_customers * CAST(0.25 AS DOUBLE))"
q(
    "campaign_roi",
    ["risk"],
    f"""SELECT targeted_customers, CAST(targeted_customers * 15 AS DOUBLE) AS campaign_cost, CAST({_SAVED} AS BIGINT) AS saved_customers,
  CAST({_SAVED} * 150 AS DOUBLE) AS gross_saved_margin, CAST({_SAVED} * 150 - targeted_customers * 15 AS DOUBLE) AS net_roi,
  {rnd(f'({_SAVED} * 150 - targeted_customers * 15) / greatest(targeted_customers * 15, 1.0) * 100.0', 2)} AS roi_pct
FROM (SELECT {_TARGETED.format(th='0.45')} AS targeted_customers FROM risk) t""",
)
q(
    "roi_curve",
    ["risk"],
    f"""SELECT {rnd('th', 6)} AS threshold, targeted_customers, CAST({_SAVED} * 150 - targeted_customers * 15 AS DOUBLE) AS net_profit
FROM (SELECT th, {_TARGETED.format(th='th')} AS targeted_customers FROM risk CROSS JOIN {_values(GRID20, 'g')} GROUP BY th) t""",
)

# -- risk table and screens --------------------------------------------------
q("risk_table", ["risk"], "SELECT * FROM risk")
q(
    "crm_audience",
    ["risk"],
    "SELECT * FROM risk WHERE risk_tier IN ('HIGH', 'MEDIUM') AND segment = 'Champions & High-Value VIPs' AND lifetime_value >= 1000.0",
)
q(
    "exec_kpis",
    ["risk", *BOTH],
    f""", months AS (SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS m, count(DISTINCT o.order_id) AS orders,
    ROUND(sum(i.price + i.freight_value), 2) AS revenue
  FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id JOIN fact_order_items i ON o.order_id = i.order_id
  WHERE {SALE} GROUP BY 1),
money AS (SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(orders) AS BIGINT) AS total_orders FROM months)
SELECT total_revenue, total_orders, count(*) AS total_customers, {rnd('total_revenue / total_orders', 2)} AS avg_order_value,
  {rnd('CAST(count(CASE WHEN churn_probability >= 0.5 THEN 1 END) AS DOUBLE) / count(*) * 100.0', 2)} AS churn_rate_pct,
  count(CASE WHEN risk_tier = 'HIGH' THEN 1 END) AS high_risk_customers,
  {rnd('CAST(count(CASE WHEN frequency > 1 THEN 1 END) AS DOUBLE) / count(*) * 100.0', 2)} AS repeat_rate_pct
FROM risk CROSS JOIN money GROUP BY 1, 2""",
)
q("tier_distribution", ["risk"], "SELECT risk_tier AS value, count(*) AS customers FROM risk GROUP BY 1")
q("segment_distribution", ["segments"], "SELECT rfm_segment AS value, count(*) AS customers FROM segments GROUP BY 1")
q(
    "segment_cards",
    ["segments"],
    f"""SELECT cluster_segment AS segment, count(*) AS customers,
  {', '.join(rnd(f'CAST(sum(CAST({c} AS DECIMAL(28,2))) AS DOUBLE) / count({c})', 2) + f' AS avg_{c}' for c in ('monetary', 'recency', 'frequency'))},
  {rnd('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100.0', 1)} AS share_pct FROM segments GROUP BY 1""",
)
q("cluster_profile", ["profile"], "SELECT * FROM profile")
q(
    "segment_sample",
    ["segments"],
    "SELECT customer_unique_id, recency, frequency, monetary, cluster_segment FROM segments ORDER BY md5('42:' || customer_unique_id), customer_unique_id LIMIT 2000",
)
_DISTANCE = "(power(CAST(a.recency AS DOUBLE) - b.recency, 2) + power(CAST(a.frequency AS DOUBLE) - b.frequency, 2) + power(CAST(a.monetary AS DOUBLE) - b.monetary, 2))"
q(
    "silhouette",
    ["clustered"],
    f""", sums AS (SELECT a.customer_unique_id AS id, a.cluster_id AS own, b.cluster_id AS other, sum({_DISTANCE}) AS total, count(*) AS n
  FROM clustered a CROSS JOIN clustered b GROUP BY 1, 2, 3),
ab AS (SELECT id, max(CASE WHEN own = other THEN total / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b,
  max(CASE WHEN own = other THEN n END) AS size FROM sums GROUP BY 1)
SELECT 'cluster_id' AS label_column, {rnd('avg(CASE WHEN size = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END)', 4)} AS silhouette FROM ab""",
)

q(
    "silhouette_euclidean",
    ["clustered"],
    f""", sums AS (SELECT a.customer_unique_id AS id, a.cluster_id AS own, b.cluster_id AS other, sum(sqrt({_DISTANCE})) AS total, count(*) AS n
  FROM clustered a CROSS JOIN clustered b GROUP BY 1, 2, 3),
ab AS (SELECT id, max(CASE WHEN own = other THEN total / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b,
  max(CASE WHEN own = other THEN n END) AS size FROM sums GROUP BY 1)
SELECT 'cluster_id' AS label_column, {rnd('avg(CASE WHEN size = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END)', 4)} AS silhouette FROM ab""",
)

# -- splits, folds, neighbours -----------------------------------------------
q(
    "fold_balance",
    [PANEL_ALL],
    f"""SELECT CAST((rk - 1) % 5 AS INT) AS fold, is_churned, count(*) AS n FROM (
  SELECT is_churned, row_number() OVER (PARTITION BY is_churned ORDER BY customer_unique_id) AS rk
  FROM {PANEL_ALL} WHERE split_role = 'train') t GROUP BY 1, 2""",
)
q(
    "fallback_split",
    [PANEL_ALL],
    f"""SELECT split_role, is_churned, count(*) AS n FROM (
  SELECT is_churned, CASE WHEN (rk - 1) / CAST(n AS DOUBLE) < 0.7 THEN 'train' WHEN (rk - 1) / CAST(n AS DOUBLE) < 0.85 THEN 'val' ELSE 'test' END AS split_role
  FROM (SELECT is_churned, row_number() OVER (PARTITION BY is_churned ORDER BY md5('42:' || customer_unique_id), customer_unique_id) AS rk,
          count(*) OVER (PARTITION BY is_churned) AS n FROM {PANEL_ALL} WHERE split_role = 'test') r) t GROUP BY 1, 2""",
)
_SQUARES = " + ".join(f"power(CAST(a.{f} AS DOUBLE) - b.{f}, 2)" for f in FEATURES)
q(
    "minority_neighbours",
    [PANEL_ALL],
    f""", few AS (SELECT * FROM {PANEL_ALL} WHERE split_role = 'test' AND is_churned = 0)
SELECT customer_unique_id, CAST(place AS BIGINT) AS place, {rnd('distance', 6)} AS distance FROM (
  SELECT a.customer_unique_id, sqrt({_SQUARES}) AS distance,
    row_number() OVER (PARTITION BY a.customer_unique_id ORDER BY sqrt({_SQUARES}), b.customer_unique_id) AS place
  FROM few a JOIN few b ON a.customer_unique_id <> b.customer_unique_id) t WHERE place <= 5""",
)
q(
    "smote_balance",
    [PANEL_ALL],
    f"""SELECT l.is_churned, m.n AS rows FROM (SELECT DISTINCT is_churned FROM {PANEL_ALL} WHERE split_role = 'train') l
CROSS JOIN (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM {PANEL_ALL} WHERE split_role = 'train' GROUP BY is_churned) c) m""",
)

# -- explanations and recommendations ----------------------------------------
# fixed values: a linear score to explain
COEFFICIENTS = {
    "recency_days": 0.004,
    "order_frequency": -0.21,
    "monetary_total": -0.000002,
    "avg_review_score": -0.35,
    "last_60d_orders": -0.4,
    "spending_trend_velocity": -0.15,
    "avg_delivery_delay_days": 0.03,
}
_IMPACTS = " UNION ALL ".join(
    f"SELECT t.customer_unique_id, {i} AS pos, '{f}' AS feature, CAST(t.{f} AS DOUBLE) AS value, "
    f"CAST({w!r} AS DOUBLE) * (t.{f} - m.{f}) AS impact FROM tested t CROSS JOIN means m"
    for i, (f, w) in enumerate(COEFFICIENTS.items())
)
_TESTED = f""", tested AS (SELECT * FROM {PANEL_ALL} WHERE split_role = 'test'),
means AS (SELECT {', '.join(f'avg(CAST({f} AS DOUBLE)) AS {f}' for f in COEFFICIENTS)} FROM tested)"""
q(
    "linear_attribution",
    [PANEL_ALL],
    _TESTED
    + f"""
SELECT customer_unique_id, CAST(place AS BIGINT) AS place, feature, {rnd('value', 6)} AS value, {rnd('impact', 6)} AS shap_impact,
  CASE WHEN impact > 0 THEN 'Pushes Risk HIGHER' ELSE 'Lowers Risk' END AS direction
FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY abs(impact) DESC, pos) AS place FROM ({_IMPACTS}) i) r
WHERE place <= 5""",
)
q(
    "global_importance",
    [PANEL_ALL],
    _TESTED
    + f""" SELECT feature, {rnd('avg(abs(impact))', 5)} AS importance FROM ({_IMPACTS}) i GROUP BY 1""",
)
_HIGH_VALUE = (
    "(" + " OR ".join(f"contains(lower(segment), '{t}')" for t in HIGH_VALUE_TERMS) + " OR lifetime_value >= 300.0)"
)
_PLAY = """CASE WHEN hv AND risk_tier = 'HIGH' THEN 'value_high' WHEN hv AND risk_tier = 'MEDIUM' THEN 'value_medium'
  WHEN hv AND risk_tier = 'LOW' THEN 'value_low' WHEN risk_tier = 'HIGH' THEN 'other_high'
  WHEN risk_tier = 'MEDIUM' THEN 'other_medium' ELSE 'other' END"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_PLAYS = ", ".join("(" + ", ".join(_text(v) for v in p.values()) + ")" for p in PLAYS)
_STRATEGY = "p.strategy"
for _mark, _expr in {
    "{spend}": "format('{:,.2f}', lifetime_value)",
    "{risk}": "format('{:.1f}', CAST(ROUND(CAST(churn_probability * 100 AS DECIMAL(28,8)), 1) AS DOUBLE)) || '%'",
    "{days}": "CAST(CAST(ROUND(CAST(recency AS DECIMAL(28,8)), 0) AS BIGINT) AS VARCHAR)",
    "{factor}": "rfm_segment",
}.items():
    _STRATEGY = f"replace({_STRATEGY}, '{_mark}', {_expr})"
q(
    "playbook",
    ["risk"],
    f""", mixed AS (SELECT *, CASE WHEN customer_unique_id % 3 = 0 THEN lifetime_value ELSE lifetime_value / 10000 END AS spend FROM risk),
valued AS (SELECT * EXCLUDE (spend, lifetime_value), {rnd('spend', 2)} AS lifetime_value FROM mixed),
judged AS (SELECT *, {_HIGH_VALUE} AS hv FROM valued)
SELECT j.* EXCLUDE (hv), hv AS is_high_value, p.action_title, {_STRATEGY} AS strategy, p.recommended_budget, p.delivery_channel, p.operational_urgency
FROM judged j JOIN (VALUES {_PLAYS}) p(play, action_title, strategy, recommended_budget, delivery_channel, operational_urgency)
  ON p.play = {_PLAY}""",
)
