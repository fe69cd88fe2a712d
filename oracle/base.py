"""Named common table expressions the oracle queries are put together from."""

from __future__ import annotations

from oracle.values import FEATURES, RFM_RULES

# dates that suit the test tables (orders run from 1995 to 2001)
SNAPSHOTS = [
    ("S1", "1998-01-01", "train"),
    ("S2", "1999-01-01", "train"),
    ("S3", "2000-01-01", "val"),
    ("S4", "2001-01-01", "test"),
]
CUTOFF = "2001-01-01"
HORIZON = 90
LOOKBACKS = [180, 365, None]


def rnd(expr: str, digits: int) -> str:
    """Rounded once, half up; the factor keeps decimal ties that binary numbers fall short of."""
    return f"ROUND(CAST({expr} AS DOUBLE) * 1.00000000000001, {digits})"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def days(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 86400000000.0)"


PARTS: dict[str, tuple[list[str], str]] = {}


def part(name: str, text: str, *needs: str) -> None:
    PARTS[name] = (list(needs), text)


def with_parts(needs: list[str], body: str) -> str:
    """WITH <needed parts in dependency order> body."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in PARTS[name][0]:
            add(need)
        order.append(name)

    for name in needs:
        add(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order) + "\n" + body


part(
    "fact_orders",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
       WHEN o_orderpriority = '5-LOW' THEN 'canceled' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unavailable'
       ELSE 'processing' END AS order_status,
  o_orderdate AS order_purchase_timestamp,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST((o_orderkey * 7) % 45 AS INT)) END
    AS order_delivered_customer_date,
  o_orderdate + to_days(25) AS order_estimated_delivery_date
FROM orders""",
)
part(
    "fact_order_items",
    """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
  l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS freight_value,
  CAST(l_quantity AS INT) AS quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS discount_amount
FROM lineitem""",
)
part(
    "dim_customers",
    """SELECT c_custkey AS customer_id, c_custkey * 2 // 3 AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
  n_name AS customer_city, r_name AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
part(
    "dim_category_translation",
    """SELECT DISTINCT p_type AS product_category_name, lower(p_type) || '_goods' AS product_category_name_english
FROM part WHERE p_type <> 'PROMO'""",
)
part(
    "dim_products",
    """SELECT p_partkey AS product_id, p_type AS product_category_name,
  COALESCE(t.product_category_name_english, 'unknown_category') AS product_category_name_english,
  p_brand AS product_brand
FROM part LEFT JOIN dim_category_translation t ON p_type = t.product_category_name""",
    "dim_category_translation",
)
part(
    "fact_order_payments",
    """SELECT o_orderkey AS order_id, 1 AS payment_sequential,
  CASE WHEN substr(o_orderpriority, 1, 1) IN ('1','2','3') THEN 'credit_card'
       WHEN substr(o_orderpriority, 1, 1) = '4' THEN 'boleto' ELSE 'voucher' END AS payment_type,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS payment_installments,
  CAST(o_totalprice AS DECIMAL(18,2)) AS payment_value
FROM orders
UNION ALL SELECT o_orderkey, 2, 'voucher', 1, CAST(5 + o_orderkey % 7 AS DECIMAL(18,2)) FROM orders WHERE o_orderkey % 4 = 0""",
)
part(
    "fact_order_reviews",
    """SELECT o_orderkey * 2 + n AS review_id, o_orderkey AS order_id,
  CASE WHEN o_orderkey % 10 <> 0 THEN CAST(1 + (o_orderkey * n * 3) % 5 AS INT) END AS review_score,
  o_orderdate + to_days(CAST((o_orderkey * 11 * n) % 60 AS INT)) AS review_creation_date
FROM (SELECT *, 1 AS n FROM orders UNION ALL SELECT *, 2 AS n FROM orders WHERE o_orderkey % 5 = 0) r""",
)
part(
    "dim_sellers",
    """SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, n_name AS seller_city, r_name AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
part(
    "geolocation",
    """SELECT c_nationkey AS geolocation_zip_code_prefix, CAST(c_acctbal AS DECIMAL(12,2)) AS geolocation_lat,
  CAST(c_custkey AS DECIMAL(12,2)) AS geolocation_lng, c_mktsegment AS geolocation_city, r_name AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)

part(
    "dim_geolocation",
    """SELECT m.geolocation_zip_code_prefix FROM (SELECT DISTINCT geolocation_zip_code_prefix FROM geolocation) m""",
    "geolocation",
)


# -- point-in-time panel -----------------------------------------------------

def snapshot_rows(lookbacks: list[int | None]) -> str:
    rows = []
    for lb in lookbacks:
        for _, date, role in SNAPSHOTS:
            low = "NULL" if lb is None else f"TIMESTAMP '{date}' - to_days({lb})"
            rows.append(
                f"(TIMESTAMP '{date}', '{date}', '{role}', {low}, {'NULL' if lb is None else lb})"
            )
    return (
        "SELECT snap, snapshot_date, split_role, CAST(low AS TIMESTAMP) AS low, "
        "CAST(lookback_days AS INT) AS lookback_days FROM (VALUES "
        + ", ".join(rows)
        + ") v(snap, snapshot_date, split_role, low, lookback_days)"
    )


def panel_parts(prefix: str, lookbacks: list[int | None]) -> str:
    """Registers <prefix>_* parts and returns the name of the finished panel part."""
    p = prefix
    roles = ["fact_orders", "fact_order_items", "dim_customers", "dim_products", "fact_order_payments", "fact_order_reviews"]
    part(f"{p}_snaps", snapshot_rows(lookbacks))
    part(
        f"{p}_obs",
        f"""SELECT s.snap, s.snapshot_date, s.split_role, s.lookback_days, c.customer_unique_id AS cust,
  o.order_id, o.order_status, o.order_purchase_timestamp AS ts, o.order_estimated_delivery_date AS est,
  CASE WHEN o.order_delivered_customer_date < s.snap THEN o.order_delivered_customer_date END AS delivered
FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
JOIN {p}_snaps s ON o.order_purchase_timestamp < s.snap AND (s.low IS NULL OR o.order_purchase_timestamp >= s.low)""",
        "fact_orders",
        "dim_customers",
        f"{p}_snaps",
    )
    key = "cust, snap, COALESCE(lookback_days, -1) AS lb"
    group = "GROUP BY cust, snap, COALESCE(lookback_days, -1)"
    part(
        f"{p}_a",
        f"""SELECT {key}, any_value(snapshot_date) AS snapshot_date, any_value(split_role) AS split_role,
  any_value(lookback_days) AS lookback_days, min(ts) AS first_ts, max(ts) AS last_ts,
  count(DISTINCT order_id) AS n_orders,
  count(DISTINCT CASE WHEN order_status = 'canceled' THEN order_id END) AS n_canceled,
  count(DISTINCT CASE WHEN ts >= snap - to_days(30) THEN order_id END) AS n30,
  count(DISTINCT CASE WHEN ts >= snap - to_days(60) THEN order_id END) AS n60,
  sum(epoch_us(delivered) - epoch_us(est)) AS delay_us, count(delivered) AS n_delivered,
  count(CASE WHEN delivered > est THEN 1 END) AS n_late
FROM {p}_obs {group}""",
        f"{p}_obs",
    )
    part(
        f"{p}_i",
        f"""SELECT {key}, sum(i.price) AS price, count(i.order_item_id) AS n_items, sum(i.freight_value) AS freight,
  count(i.freight_value) AS n_freight, count(DISTINCT p.product_category_name_english) AS n_cat,
  sum(CASE WHEN ts >= snap - to_days(60) THEN i.price END) AS price60
FROM {p}_obs o JOIN fact_order_items i ON o.order_id = i.order_id
LEFT JOIN dim_products p ON i.product_id = p.product_id {group}""",
        f"{p}_obs",
        "fact_order_items",
        "dim_products",
    )
    part(
        f"{p}_p",
        f"""SELECT {key}, sum(payment_value) AS paid, sum(payment_installments) AS inst, count(payment_installments) AS n_inst,
  sum(CASE WHEN payment_type = 'credit_card' THEN payment_value END) AS card,
  sum(CASE WHEN payment_type = 'boleto' THEN payment_value END) AS boleto,
  sum(CASE WHEN payment_type = 'voucher' THEN payment_value END) AS voucher
FROM {p}_obs o JOIN fact_order_payments y ON o.order_id = y.order_id {group}""",
        f"{p}_obs",
        "fact_order_payments",
    )
    part(
        f"{p}_r",
        f"""SELECT {key}, sum(review_score) AS score, count(review_score) AS n_score
FROM {p}_obs o JOIN fact_order_reviews r ON o.order_id = r.order_id AND r.review_creation_date < o.snap {group}""",
        f"{p}_obs",
        "fact_order_reviews",
    )
    part(
        f"{p}_mo",
        f"""SELECT cust, snap, COALESCE(lookback_days, -1) AS lb, max(price) AS max_order
FROM (SELECT cust, snap, lookback_days, o.order_id, sum(i.price) AS price
      FROM {p}_obs o JOIN fact_order_items i ON o.order_id = i.order_id
      GROUP BY cust, snap, lookback_days, o.order_id) t {group}""",
        f"{p}_obs",
        "fact_order_items",
    )
    part(
        f"{p}_kept",
        f"""SELECT DISTINCT c.customer_unique_id AS cust, s.snap
FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
JOIN {p}_snaps s ON o.order_purchase_timestamp BETWEEN s.snap AND s.snap + to_days({HORIZON})
WHERE o.order_status NOT IN ('canceled','unavailable')""",
        "fact_orders",
        "dim_customers",
        f"{p}_snaps",
    )
    tenure = days("a.first_ts", "a.snap")
    total = "COALESCE(CAST(i.price AS DOUBLE), 0.0)"
    part(
        f"{p}_panel",
        f"""SELECT a.cust AS customer_unique_id,
  {days('a.last_ts', 'a.snap')} AS recency_days,
  a.n_orders AS order_frequency,
  {total} AS monetary_total,
  COALESCE(CAST(i.price AS DOUBLE) / greatest(CAST(a.n_orders AS DOUBLE), 1.0), 0.0) AS avg_order_value,
  COALESCE(i.n_items, 1) AS total_quantity,
  {tenure} AS customer_tenure_days,
  COALESCE(CAST(i.freight AS DOUBLE) / i.n_freight, 0.0) AS avg_freight_value,
  COALESCE(CAST(i.freight AS DOUBLE) / greatest(CAST(i.price + i.freight AS DOUBLE), 0.01), 0.0) AS freight_ratio,
  COALESCE(i.n_cat, 1) AS category_diversity,
  COALESCE(CAST(r.score AS DOUBLE) / r.n_score, 4.0) AS avg_review_score,
  a.n_canceled AS cancelled_orders_cnt,
  COALESCE(CAST(p.card AS DOUBLE) / greatest(CAST(p.paid AS DOUBLE), 0.01), 0.0) AS credit_card_share,
  COALESCE(CAST(p.inst AS DOUBLE) / p.n_inst, 1.0) AS avg_installments,
  a.n30 AS last_30d_orders, a.n60 AS last_60d_orders,
  COALESCE(CAST(i.price60 AS DOUBLE) / greatest(CAST(i.price AS DOUBLE) / greatest({tenure}, 60.0) * 60.0, 1.0), 0.0)
    AS spending_trend_velocity,
  COALESCE(CAST(a.delay_us AS DOUBLE) / nullif(a.n_delivered, 0) / 86400000000.0, 0.0) AS avg_delivery_delay_days,
  CASE WHEN k.cust IS NULL THEN 1 ELSE 0 END AS is_churned,
  a.snapshot_date, a.split_role, a.lookback_days,
  COALESCE(CAST(mo.max_order AS DOUBLE), 0.0) AS max_order_value,
  CAST(COALESCE(i.n_items, 1) AS DOUBLE) / a.n_orders AS items_per_order,
  COALESCE(CAST(i.price AS DOUBLE) / i.n_items, 0.0) AS avg_item_price,
  COALESCE(CAST(p.boleto AS DOUBLE) / greatest(CAST(p.paid AS DOUBLE), 0.01), 0.0) AS pct_boleto,
  COALESCE(CAST(p.voucher AS DOUBLE) / greatest(CAST(p.paid AS DOUBLE), 0.01), 0.0) AS pct_voucher,
  a.n_late AS late_delivery_count,
  {days('a.first_ts', 'a.last_ts')} AS customer_lifetime_days
FROM {p}_a a
LEFT JOIN {p}_i i ON a.cust = i.cust AND a.snap = i.snap AND a.lb = i.lb
LEFT JOIN {p}_p p ON a.cust = p.cust AND a.snap = p.snap AND a.lb = p.lb
LEFT JOIN {p}_r r ON a.cust = r.cust AND a.snap = r.snap AND a.lb = r.lb
LEFT JOIN {p}_mo mo ON a.cust = mo.cust AND a.snap = mo.snap AND a.lb = mo.lb
LEFT JOIN {p}_kept k ON a.cust = k.cust AND a.snap = k.snap""",
        f"{p}_a",
        f"{p}_i",
        f"{p}_p",
        f"{p}_r",
        f"{p}_mo",
        f"{p}_kept",
        *roles,
    )
    return f"{p}_panel"


PANEL_ALL = panel_parts("pa", [None])
PANEL_180 = panel_parts("pb", [180])
PANEL_365 = panel_parts("pc", [365])
PANEL_EVERY = panel_parts("pe", LOOKBACKS)

PANEL_COLUMNS = ", ".join(["customer_unique_id", *FEATURES, "is_churned", "snapshot_date", "split_role"])

# -- RFM, segments and a fixed score to check everything downstream of a model -

QCUT = "greatest(1, CAST(ceil(5 * ({r} - 1) / (n - 1.0)) AS INT))"


def rfm_case(rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{label}'" for c, label in rules) + " END"


part(
    "rfm_values",
    f"""SELECT c.customer_unique_id, max(o.order_purchase_timestamp) AS latest_order,
  count(DISTINCT o.order_id) AS frequency, {rnd('sum(i.price)', 2)} AS monetary,
  {rnd(days('max(o.order_purchase_timestamp)', f"TIMESTAMP '{CUTOFF}'"), 1)} AS recency
FROM fact_orders o JOIN fact_order_items i ON o.order_id = i.order_id
JOIN dim_customers c ON o.customer_id = c.customer_id
WHERE o.order_purchase_timestamp < TIMESTAMP '{CUTOFF}'
  AND COALESCE(o.order_status NOT IN ('canceled','unavailable'), true)
GROUP BY c.customer_unique_id""",
    "fact_orders",
    "fact_order_items",
    "dim_customers",
)
part(
    "rfm_ranked",
    """SELECT *, count(*) OVER () AS n,
  row_number() OVER (ORDER BY recency DESC, customer_unique_id) AS rr,
  row_number() OVER (ORDER BY frequency, customer_unique_id) AS fr,
  row_number() OVER (ORDER BY monetary, customer_unique_id) AS mr FROM rfm_values""",
    "rfm_values",
)
part(
    "rfm_scored",
    f"""SELECT customer_unique_id, latest_order, frequency, monetary, recency,
  {QCUT.format(r='rr')} AS r_score, {QCUT.format(r='fr')} AS f_score, {QCUT.format(r='mr')} AS m_score
FROM rfm_ranked""",
    "rfm_ranked",
)
# a fixed score between 0 and 0.999 stands in for a model's probability
SCORE = (
    "CAST((order_frequency * 37 + total_quantity * 11 + CAST(floor(monetary_total) AS BIGINT)) % 1000 AS DOUBLE) / 1000.0"
)
part("scored", f"SELECT *, {SCORE} AS p FROM {PANEL_ALL}", PANEL_ALL)
part(
    "curve",
    """SELECT split_role, p, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER (PARTITION BY split_role) AS all_pos, sum(neg) OVER (PARTITION BY split_role) AS all_neg
FROM (SELECT split_role, p, CAST(sum(is_churned) AS BIGINT) AS pos, CAST(sum(1 - is_churned) AS BIGINT) AS neg FROM scored GROUP BY 1, 2) t
WINDOW w AS (PARTITION BY split_role ORDER BY p DESC)""",
    "scored",
)
# a fixed cluster per customer stands in for K-means
part("clustered", "SELECT *, customer_unique_id % 4 AS cluster_id FROM rfm_scored", "rfm_scored")
_MEANS = ", ".join(
    f"CAST(sum(CAST({c} AS DECIMAL(28,2))) AS DOUBLE) / count({c}) AS avg_{c}" for c in ("recency", "frequency", "monetary")
)
part(
    "profile",
    f"""SELECT cluster_id, customer_count, avg_recency, avg_frequency, avg_monetary, median_monetary, pct_customers,
  CASE WHEN rk = 1 THEN 'Champions & High-Value VIPs'
       WHEN avg_recency > 180 AND avg_monetary > mid THEN 'At-Risk High Spenders'
       WHEN avg_recency <= 150 AND avg_frequency >= 1.5 THEN 'Loyal & Consistent'
       ELSE 'Hibernating / One-Time Buyers' END AS segment_name
FROM (SELECT *, {rnd('CAST(customer_count AS DOUBLE) / sum(customer_count) OVER () * 100.0', 2)} AS pct_customers,
        row_number() OVER (ORDER BY avg_monetary DESC, cluster_id) AS rk, median(avg_monetary) OVER () AS mid
      FROM (SELECT cluster_id, count(*) AS customer_count, {_MEANS}, quantile_cont(monetary, 0.5) AS median_monetary
            FROM clustered GROUP BY 1) c) x""",
    "clustered",
)
part(
    "segments",
    f"""SELECT c.*, p.segment_name AS cluster_segment, {rfm_case(RFM_RULES)} AS rfm_segment
FROM clustered c JOIN profile p ON c.cluster_id = p.cluster_id""",
    "clustered",
    "profile",
)
TIER = "CASE WHEN {p} >= 0.7 THEN 'HIGH' WHEN {p} >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END"
part(
    "risk",
    f"""SELECT s.customer_unique_id, s.customer_unique_id AS customer_id, {rnd('s.p', 4)} AS churn_probability,
  {TIER.format(p=rnd('s.p', 4))} AS risk_tier, COALESCE(g.cluster_segment, 'Standard') AS segment,
  COALESCE(g.rfm_segment, 'Standard') AS rfm_segment, {rnd('s.monetary_total', 2)} AS lifetime_value,
  {rnd('s.recency_days', 1)} AS recency, s.order_frequency AS frequency, {rnd('s.avg_order_value', 2)} AS avg_order_value
FROM scored s LEFT JOIN segments g ON s.customer_unique_id = g.customer_unique_id WHERE s.split_role = 'test'""",
    "scored",
    "segments",
)
