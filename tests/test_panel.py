"""Hand-made customers around the snapshot edges, and invariants on the test tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepwell.operators.activity import gaps, second_order_within
from keepwell.plans import panel
from keepwell.settings import FEATURE_DEFAULTS, FEATURES, Snapshot
from keepwell.sources import writers

SNAP = Snapshot("S", "2018-06-01", "test", 90)


def ts(text):
    return dt.datetime.fromisoformat(text) if text else None


@pytest.fixture(scope="module")
def tables(spark):
    orders = [
        # before the snapshot, delivered exactly at the snapshot instant: hidden
        ("o1", "a1", "delivered", "2018-05-20 12:00:00", "2018-06-01 00:00:00", "2018-05-30 00:00:00"),
        ("o2", "a2", "delivered", "2018-01-02 00:00:00", "2018-01-12 00:00:00", "2018-01-10 12:00:00"),
        # exactly at snapshot + 90 days: still inside the label window
        ("o3", "a3", "shipped", "2018-08-30 00:00:00", None, "2018-09-10 00:00:00"),
        # b: only an order that is one second too late
        ("o4", "b1", "canceled", "2018-04-01 00:00:00", None, "2018-04-20 00:00:00"),
        ("o5", "b2", "shipped", "2018-08-30 00:00:01", None, "2018-09-10 00:00:00"),
        # c: comes back, but the order is unavailable
        ("o6", "c1", None, "2018-05-31 23:59:59", None, "2018-06-20 00:00:00"),
        ("o7", "c2", "unavailable", "2018-06-01 00:00:00", None, "2018-06-20 00:00:00"),
        # d: first order exactly at the snapshot, not observed
        ("o8", "d1", "delivered", "2018-06-01 00:00:00", None, "2018-06-20 00:00:00"),
        # e: comes back with an order of unknown status: kept
        ("o9", "e1", "delivered", "2017-11-01 00:00:00", None, "2017-12-01 00:00:00"),
        ("o10", "e1", None, "2018-07-01 00:00:00", None, "2018-07-11 00:00:00"),
    ]
    rows = [(o, c, s, ts(p), ts(d), ts(e)) for o, c, s, p, d, e in orders]
    return {
        "fact_orders": spark.createDataFrame(
            rows,
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,"
            " order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
        ),
        "dim_customers": spark.createDataFrame(
            [(c, c[0]) for c in ("a1", "a2", "a3", "b1", "b2", "c1", "c2", "d1", "e1")],
            "customer_id string, customer_unique_id string",
        ),
        "fact_order_items": spark.createDataFrame(
            [("o1", 1, "p1", 10.0, 2.0), ("o1", 2, "p2", 20.0, 3.0), ("o2", 1, "p1", 70.0, 5.0), ("o3", 1, "p1", 999.0, 9.0), ("o9", 1, "px", 5.0, 0.0)],
            "order_id string, order_item_id int, product_id string, price double, freight_value double",
        ).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "freight_value")}),
        "dim_products": spark.createDataFrame(
            [("p1", "bed"), ("p2", "toys")], "product_id string, product_category_name_english string"
        ),
        "fact_order_payments": spark.createDataFrame(
            [("o1", 1, "credit_card", 3, 25.0), ("o1", 2, "voucher", 1, 10.0), ("o2", 1, "boleto", 1, 75.0)],
            "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        ).withColumn("payment_value", F.col("payment_value").cast("decimal(18,2)")),
        "fact_order_reviews": spark.createDataFrame(
            [("r1", "o1", 1, ts("2018-06-01 00:00:00")), ("r2", "o2", 5, ts("2018-01-20 00:00:00")), ("r3", "o1", 2, ts("2018-05-31 00:00:00"))],
            "review_id string, order_id string, review_score int, review_creation_date timestamp_ntz",
        ),
    }


@pytest.fixture(scope="module")
def built(tables):
    return {r["customer_unique_id"]: r for r in panel.churn_panel(tables, [SNAP]).collect()}


def test_population_and_labels(built):
    assert set(built) == {"a", "b", "c", "e"}
    assert {k: r["is_churned"] for k, r in built.items()} == {"a": 0, "b": 1, "c": 1, "e": 0}
    assert all(r["snapshot_date"] == "2018-06-01" and r["split_role"] == "test" for r in built.values())


def test_features_of_a(built):
    a = built["a"]
    assert a["recency_days"] == 11.5
    assert a["customer_tenure_days"] == 150.0
    assert a["order_frequency"] == 2
    assert a["monetary_total"] == 100.0 and a["avg_order_value"] == 50.0
    assert a["total_quantity"] == 3
    assert a["avg_freight_value"] == pytest.approx(10 / 3)
    assert a["freight_ratio"] == pytest.approx(10 / 110)
    assert a["category_diversity"] == 2
    assert a["avg_review_score"] == 3.5  # the review written at the snapshot is not known yet
    assert a["cancelled_orders_cnt"] == 0
    assert a["credit_card_share"] == pytest.approx(25 / 110)
    assert a["avg_installments"] == pytest.approx(5 / 3)
    assert (a["last_30d_orders"], a["last_60d_orders"]) == (1, 1)
    assert a["spending_trend_velocity"] == pytest.approx(30 / (100 / 150 * 60))
    assert a["avg_delivery_delay_days"] == 1.5  # only o2; o1 arrives at the snapshot


def test_defaults_when_nothing_is_known(built):
    b = built["b"]
    for name in ("monetary_total", "total_quantity", "category_diversity", "avg_review_score", "avg_installments", "credit_card_share", "avg_delivery_delay_days", "spending_trend_velocity"):
        assert b[name] == FEATURE_DEFAULTS[name], name
    assert b["cancelled_orders_cnt"] == 1
    assert built["e"]["category_diversity"] == 1  # product without a known category
    assert built["c"]["recency_days"] == pytest.approx(1 / 86400)


def test_lookback_drops_old_customers_and_orders(tables):
    got = {r["customer_unique_id"]: r for r in panel.churn_panel(tables, [SNAP], 90).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["order_frequency"] == 1 and got["a"]["customer_tenure_days"] == 11.5


def test_more_windows_than_mask_bits(tables, built):
    snaps = [Snapshot(f"S{i}", str(dt.date(2017, 1, 1) + dt.timedelta(days=7 * i)), "train") for i in range(70)]
    got = panel.churn_panel(tables, [*snaps, SNAP]).filter(F.col("snapshot_date") == SNAP.date).collect()
    for r in got:
        assert [r[f] for f in FEATURES] == [built[r["customer_unique_id"]][f] for f in FEATURES]


def test_target_document_and_writing(spark, tables, tmp_path):
    built = panel.churn_panel(tables, [SNAP])
    doc = panel.target_document(built, [SNAP]).first()
    assert (doc["observations"], doc["churned"], doc["unique_customers"]) == (4, 2, 4)
    assert doc["customer_snapshot_frequency"][0].asDict() == {"snapshots": 1, "customers": 4}
    writers.write_json(panel.target_document(built, [SNAP]), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first()["num_snapshots"] == 1
    writers.write_panel(built, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "churn_features")).count() == 4
    writers.write_holdout(built, FEATURES, "is_churned", str(tmp_path / "holdout"))
    assert "customer_id" in spark.read.parquet(str(tmp_path / "holdout")).columns


def test_no_feature_uses_the_future(spark):
    """Dropping everything from the snapshot on changes labels only."""
    from catalogue import SNAPSHOTS
    from keepwell.sources.star import role_tables

    t = role_tables(spark, "/root/testdata/sf0.001")
    last = SNAPSHOTS[-1]
    cut = F.lit(last.date).cast("timestamp_ntz")
    past = {
        **t,
        "fact_orders": t["fact_orders"].filter(F.col("order_purchase_timestamp") < cut),
        "fact_order_reviews": t["fact_order_reviews"].filter(F.col("review_creation_date") < cut),
    }
    columns = ["customer_unique_id", *FEATURES]
    whole = panel.churn_panel(t, [last]).select(*columns)
    earlier = panel.churn_panel(past, [last]).select(*columns)
    assert whole.exceptAll(earlier).isEmpty() and earlier.exceptAll(whole).isEmpty()


def test_gaps_of_a_busy_customer_equal_a_plain_window(spark):
    """One customer holds a third of all orders, many of them on the same day."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("customer"),
        (F.lit("2018-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 7919 % 40000).cast("int"))).alias("ts"),
    )
    got = gaps(rows, "customer", "ts", 1).toPandas().set_index("customer").sort_index()
    rows.createOrReplaceTempView("busy")
    plain = spark.sql(
        """SELECT customer, count(*) AS gap_count, sum(gap) AS gap_sum, min(gap) AS gap_min, max(gap) AS gap_max FROM (
        SELECT customer, round(cast(timestampdiff(MICROSECOND, lag(ts) OVER (PARTITION BY customer ORDER BY ts), ts) / 86400e6 AS decimal(28,8)), 1) AS gap
        FROM busy) WHERE gap IS NOT NULL GROUP BY customer"""
    ).toPandas().set_index("customer").sort_index()
    assert got.astype(float).equals(plain.astype(float))


def test_second_order(spark):
    rows = spark.createDataFrame(
        [("a", ts("2018-01-01 10:00:00")), ("a", ts("2018-03-02 10:00:00")),
         ("b", ts("2018-01-01 10:00:00")), ("b", ts("2018-03-02 10:00:01")),
         ("c", ts("2018-01-01 10:00:00")), ("c", ts("2018-01-01 10:00:00")), ("d", ts("2018-01-01 00:00:00"))],
        "customer string, ts timestamp_ntz",
    )
    got = {r["customer"]: r["has_second_order"] for r in second_order_within(rows, "customer", "ts", 60).collect()}
    assert got == {"a": 1, "b": 0, "c": 1, "d": 0}


def test_leakage_audit_sees_what_entered_the_rows(spark):
    """Panels whose sums hold something of the future are caught, whichever instant it is."""
    from datetime import datetime

    early, late = datetime(2018, 1, 1), datetime(2018, 3, 1)
    schema = (
        "snapshot_date string, lookback_days int, recency_days double, last_purchase timestamp_ntz, last_delivery timestamp_ntz, "
        "last_review timestamp_ntz, hidden_deliveries long"
    )
    good = ("2018-03-01", None, 59.0, early, early, None, 2)
    bad = [("2018-03-01", None, 0.0, late, None, None, 0), ("2018-03-01", None, 1.0, early, late, None, 0),
           ("2018-03-01", None, 1.0, early, None, late, 0), ("2018-03-01", None, -0.5, early, None, None, None)]
    (row,) = panel.leakage_audit(spark.createDataFrame([good, good], schema)).collect()
    assert tuple(row) == ("2018-03-01", None, early, 0, 4)
    for one in bad:
        assert panel.leakage_audit(spark.createDataFrame([good, one], schema)).first()["future_purchase_detected"] == 1
