"""Rows loaded twice, snapshots, rounding, shared folders and pruned scans."""

import datetime

import pytest
from pyspark.sql import functions as F

from keepwell.functions.exprs import rounded, rounded_days
from keepwell.plans import panel, revenue, rfm
from keepwell.session import materialize, scratch, shared_folder, size_partitions
from keepwell.settings import Snapshot
from keepwell.sources.star import role_tables

FOLDER = "/root/testdata/sf0.001"
SNAPSHOTS = (Snapshot("S3", "2000-01-01", "val"), Snapshot("S4", "2001-01-01", "test"))


@pytest.fixture(scope="module")
def tables(spark):
    return role_tables(spark, FOLDER)


@pytest.fixture(scope="module")
def twice(tables):
    return {**tables, "fact_orders": tables["fact_orders"].unionByName(tables["fact_orders"])}


def by_key(frame, *columns):
    return {r[0]: tuple(r)[1:] for r in frame.select(*columns).collect()}


def test_orders_loaded_twice_count_once_in_reports(tables, twice):
    for report, key, counts, sums in (
        (lambda t: revenue.monthly_revenue(t["fact_orders"], t["dim_customers"], t["fact_order_items"]), "order_month", ["total_orders", "unique_customers"], "item_revenue"),
        (lambda t: revenue.category_performance(t["fact_order_items"], t["dim_products"], t["fact_orders"]), "category_name", ["orders_count"], "category_revenue"),
        (lambda t: rfm.rfm_values(t["fact_orders"], t["fact_order_items"], t["dim_customers"], "2001-01-01"), "customer_unique_id", ["frequency"], "monetary"),
    ):
        once, double = report(tables), report(twice)
        assert by_key(once, key, *counts) == by_key(double, key, *counts)
        # a join to order rows that are there twice doubles the sums, as in plain SQL
        a, b = by_key(once, key, sums), by_key(double, key, sums)
        assert all(b[k][0] == pytest.approx(2 * a[k][0]) for k in a if a[k][0] is not None)


def test_orders_loaded_twice_count_once_in_the_panel(tables, twice):
    names = ["customer_unique_id", "snapshot_date", "order_frequency", "last_60d_orders", "cancelled_orders_cnt", "category_diversity", "avg_review_score", "is_churned"]
    rows = [sorted(map(tuple, panel.churn_panel(t, SNAPSHOTS).select(*names).collect())) for t in (tables, twice)]
    assert rows[0] == rows[1]
    money = [
        {(r[0], r[1]): (r[2], r[3]) for r in panel.churn_panel(t, SNAPSHOTS).select("customer_unique_id", "snapshot_date", "monetary_total", "total_quantity").collect()}
        for t in (tables, twice)
    ]
    for k, (spend, quantity) in money[0].items():
        if spend:
            assert money[1][k] == pytest.approx((2 * spend, 2 * quantity))


def test_dormancy_knows_only_what_came_before_the_snapshot(spark):
    when = datetime.datetime
    orders = spark.createDataFrame(
        [
            ("a", when(2018, 1, 1)), ("a", when(2018, 1, 20)),  # second in time
            ("b", when(2018, 1, 1)), ("b", when(2018, 6, 1)),  # second too late
            ("c", when(2018, 1, 1)),
            ("d", when(2018, 3, 1)), ("d", when(2018, 4, 2)),  # its 60 days are not over at the snapshot
            ("e", when(2018, 1, 31)), ("e", when(2018, 4, 1)),  # second at the snapshot itself
            ("f", when(2018, 1, 1, 9)), ("f", when(2018, 1, 1, 10)),
        ],
        "customer_id string, order_purchase_timestamp timestamp_ntz",
    )
    customers = orders.select("customer_id", F.col("customer_id").alias("customer_unique_id")).distinct()
    rows = spark.createDataFrame([(c, "2018-04-01", int(c in "bc")) for c in "abcdef"], "customer_unique_id string, snapshot_date string, is_churned int")
    got = {r["has_second_order"]: (r["observations"], r["churned"]) for r in panel.dormancy(orders, customers, rows).collect()}
    assert got == {0: (3, 2), 1: (2, 0)}


@pytest.mark.parametrize(
    "value, digits, expected",
    [(12.499999998, 0, 12.0), (12.5, 0, 13.0), (0.145, 2, 0.15), (-0.145, 2, -0.15), (1.005, 2, 1.01), (2.675, 2, 2.68), (0.1 + 0.2, 1, 0.3)],
)
def test_rounding_once(spark, value, digits, expected):
    assert spark.range(1).select(rounded(F.lit(value), digits)).first()[0] == expected


def test_exact_decimals_are_rounded_exactly(spark):
    wide = F.lit("123456789012345.675").cast("decimal(28,3)")
    assert spark.range(1).select(rounded(wide, 2)).first()[0] == 123456789012345.68


def test_days_are_rounded_on_microseconds(spark):
    start = F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")
    for text, digits, expected in (("2018-01-13 11:59:59.999999", 0, 12.0), ("2018-01-13 12:00:00", 0, 13.0), ("2018-01-01 01:12:00", 1, 0.1), ("2018-01-01 01:11:59", 1, 0.0)):
        end = F.lit(text).cast("timestamp_ntz")
        assert spark.range(1).select(rounded_days(start, end, digits)).first()[0] == expected


def test_panel_scans_each_fact_once_and_only_orders_in_reach(spark, tables):
    frame = panel.churn_panel(tables, SNAPSHOTS, 180)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("l_linenumber") and len([x for x in plan.split("\n") if "FileScan" in x and "lineitem" in x]) == 1
    assert plan.count("LeftSemi") >= 3  # items, payments and reviews


def test_materialized_panel_is_read_by_column(spark, tables):
    stored = materialize(panel.churn_panel(tables, SNAPSHOTS, 180))
    plan = stored.select("recency_days")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<recency_days:double>" in plan


def test_folders_and_partitions(spark, tmp_path):
    assert scratch(spark, "x").startswith(shared_folder(spark))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_partitions(spark, f"{FOLDER}/lineitem.parquet", partition_bytes=1000) > int(before)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert size_partitions(spark, f"{FOLDER}/lineitem.parquet") == int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
