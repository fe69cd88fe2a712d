"""Hot keys: a third of the rows share one key, and joins cannot broadcast."""

import contextlib

import pytest
from pyspark.sql import functions as F

from keepwell.plans import panel, revenue
from keepwell.settings import Snapshot

SNAP = Snapshot("S", "2018-06-01", "test", 90)


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cluster_like(spark):
    """Large tables as on a cluster, scaled down: no broadcast, small partitions."""
    return settings(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
        },
    )


@pytest.fixture(scope="module")
def hot(spark):
    """Customer 0 places a third of the orders, product 0 is a third of the items,
    order 0 holds a third of the items."""
    n = 30000
    when = F.lit("2017-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 600).cast("int"))
    ids = spark.range(0, n, 1, 8)
    orders = ids.select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        when.alias("order_purchase_timestamp"),
        (when + F.make_dt_interval(F.lit(5))).alias("order_delivered_customer_date"),
        (when + F.make_dt_interval(F.lit(9))).alias("order_estimated_delivery_date"),
    )
    items = spark.range(0, 2 * n, 1, 8).select(
        F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % n).alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.when(F.col("id") % 3 == 2, 0).otherwise(F.col("id") % 700).alias("product_id"),
        (F.col("id") % 100).cast("decimal(18,2)").alias("price"),
        F.lit(1).cast("decimal(18,2)").alias("freight_value"),
    )
    return {
        "fact_orders": orders,
        "fact_order_items": items,
        "dim_customers": spark.range(5000).select(
            F.col("id").alias("customer_id"), F.col("id").alias("customer_unique_id")
        ),
        "dim_products": spark.range(700).select(
            F.col("id").alias("product_id"),
            F.concat(F.lit("c"), F.col("id") % 40).alias("product_category_name_english"),
        ),
        "fact_order_payments": ids.select(
            F.col("id").alias("order_id"), F.lit("credit_card").alias("payment_type"),
            F.lit(1).alias("payment_installments"), F.lit(5).cast("decimal(18,2)").alias("payment_value"),
        ),
        "fact_order_reviews": ids.select(
            F.col("id").alias("order_id"), F.lit(4).alias("review_score"), when.alias("review_creation_date")
        ),
    }


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_do_not_change_results(spark, hot):
    names = ["customer_unique_id", "order_frequency", "monetary_total", "total_quantity", "category_diversity", "is_churned"]
    usual = {r[0]: tuple(r) for r in panel.churn_panel(hot, [SNAP]).select(*names).collect()}
    with cluster_like(spark):
        split = {r[0]: tuple(r) for r in panel.churn_panel(hot, [SNAP]).select(*names).collect()}
    assert usual == split
    assert usual[0][1] > len(usual)  # the hot customer is really hot


def test_joins_on_hot_customers_and_products_are_split(spark, hot):
    with cluster_like(spark):
        by_customer = revenue.monthly_revenue(hot["fact_orders"], hot["dim_customers"], hot["fact_order_items"])
        by_customer.collect()
        assert "isSkew=true" in final_plan(by_customer) or "skew=true" in final_plan(by_customer)
        by_product = revenue.category_performance(hot["fact_order_items"], hot["dim_products"], hot["fact_orders"])
        by_product.collect()
        assert "isSkew=true" in final_plan(by_product) or "skew=true" in final_plan(by_product)


def test_items_are_reduced_before_they_meet_orders(spark, hot):
    """The order with a third of all items reaches its join as one row per task."""
    with cluster_like(spark):
        report = revenue.eda_monthly(hot["fact_orders"], hot["fact_order_items"])
        lines = report._jdf.queryExecution().executedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    partial = next(i for i, line in enumerate(lines) if "partial_sum(price" in line)
    assert join < partial  # the sum lies below the join
    assert not any("SinglePartition" in line for line in lines)


def test_panel_bounds_reach_the_scan(spark):
    from catalogue import SNAPSHOTS
    from keepwell.sources.star import role_tables

    t = role_tables(spark, "/root/testdata/sf0.001")
    plan = final_plan(panel.churn_panel(t, SNAPSHOTS, 180))
    assert "LessThanOrEqual(o_orderdate" in plan and "GreaterThanOrEqual(o_orderdate" in plan


@pytest.mark.parametrize("name", ["rfm", "spend_quartiles", "feature_stats", "purchase_gaps", "roc_points", "cohort_retention"])
def test_no_window_in_one_task_over_customers(spark, name):
    """What remains to be run after the ordering step has no single-partition exchange,
    but for frames of a few rows."""
    from __spark_entry__ import queries

    plan = final_plan(queries()[name](spark, "/root/testdata/sf0.001"))
    singles = [line for line in plan.split("\n") if "SinglePartition" in line]
    # the only ones allowed order the (few) blocks of the global sort
    assert len(singles) <= (1 if name in ("rfm", "spend_quartiles", "feature_stats", "roc_points") else 0), singles
