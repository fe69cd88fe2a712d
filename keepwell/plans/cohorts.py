"""Monthly acquisition cohorts and how many of their customers come back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from keepwell.functions.exprs import month_number, month_text, ratio, rounded
from keepwell.plans.revenue import sales
from keepwell.settings import INACTIVE_STATUSES


def cohort_retention(
    orders: DataFrame,
    customers: DataFrame | None = None,
    customer: str = "customer_unique_id",
    months: int = 12,
    excluded: Sequence[str] = INACTIVE_STATUSES,
) -> DataFrame:
    """cohort_month, cohort_size, cohort_index, active_customers, retention_rate_pct.

    Orders shrink to one row per customer and month first; the first month of
    a customer is then a window over a few months.  Every customer is active in
    month 0, so the cohort size is the month-0 count and needs no second pass.
    """
    sold = sales(orders, excluded).select(
        "customer_id",
        month_text("order_purchase_timestamp").alias("month"),
        month_number("order_purchase_timestamp").alias("month_no"),
    )
    if customers is not None:
        sold = sold.join(customers.select("customer_id", customer), "customer_id")
    active = sold.groupBy(customer, "month", "month_no").agg(F.count(F.lit(1)).alias("orders"))
    own = W.partitionBy(customer)
    counted = (
        active.withColumn("cohort_month", F.min("month").over(own))
        .withColumn("cohort_index", F.col("month_no") - F.min("month_no").over(own))
        .filter(F.col("cohort_index").between(0, months))
        .groupBy("cohort_month", "cohort_index")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    size = F.max(F.when(F.col("cohort_index") == 0, F.col("active_customers"))).over(
        W.partitionBy("cohort_month")
    )
    return (
        counted.withColumn("cohort_size", size)
        .select(
            "cohort_month",
            "cohort_size",
            F.col("cohort_index").cast("bigint").alias("cohort_index"),
            "active_customers",
            rounded(ratio("active_customers", "cohort_size") * 100.0, 2).alias("retention_rate_pct"),
        )
        .orderBy("cohort_month", "cohort_index")
    )


def cohort_matrix(retention: DataFrame, months: int = 12) -> DataFrame:
    """The same as one row per cohort with a column per month (m0 .. m12)."""
    return (
        retention.groupBy("cohort_month", "cohort_size")
        .pivot("cohort_index", list(range(months + 1)))
        .agg(F.max("retention_rate_pct"))
        .withColumnsRenamed({str(i): f"m{i}" for i in range(months + 1)})
        .orderBy("cohort_month")
    )
