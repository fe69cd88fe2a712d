"""Per-customer time series, kept safe against customers with very many orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from keepwell.functions.exprs import days_between, hour_number, rounded


def daily_activity(orders: DataFrame, customer: str, ts: str) -> DataFrame:
    """One row per customer and calendar day: first and last instant, order count.

    A customer has at most one row per day of history, however many orders
    they placed, so the next window over a customer is bounded by the calendar.
    """
    return (
        orders.filter(F.col(ts).isNotNull())
        .groupBy(customer, F.col(ts).cast("date").alias("day"))
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.count(F.lit(1)).alias("orders"),
        )
    )


def gaps(orders: DataFrame, customer: str, ts: str, digits: int = 1) -> DataFrame:
    """Per customer: number, sum, smallest and largest gap in days to the previous order.

    Orders at the same instant become one row first (their gaps are zero); gaps
    inside an hour and gaps between active hours are then found separately.  So
    no window grows with the number of orders: one holds the instants of one
    customer-hour, the other one row per hour of a customer's history.
    """
    instants = (
        orders.filter(F.col(ts).isNotNull())
        .groupBy(customer, F.col(ts).alias("at"))
        .agg((F.count(F.lit(1)) - 1).alias("repeats"))
        .withColumn("hour", hour_number("at"))
    )
    previous = F.lag("at").over(W.partitionBy(customer, "hour").orderBy("at"))
    per_hour = (
        instants.withColumn("gap", _gap(previous, F.col("at"), digits))
        .groupBy(customer, "hour")
        .agg(
            F.min("at").alias("first_ts"),
            F.max("at").alias("last_ts"),
            F.sum("repeats").alias("repeats"),
            F.count("gap").alias("n"),
            F.sum("gap").alias("total"),
            F.min("gap").alias("low"),
            F.max("gap").alias("high"),
        )
    )
    last_before = F.lag("last_ts").over(W.partitionBy(customer).orderBy("hour"))
    zero = F.lit(0).cast(f"decimal(18,{digits})")
    return (
        per_hour.withColumn("gap", _gap(last_before, F.col("first_ts"), digits))
        .groupBy(customer)
        .agg(
            (F.sum("repeats") + F.sum("n") + F.count("gap")).alias("gap_count"),
            (F.coalesce(F.sum("total"), zero) + F.coalesce(F.sum("gap"), zero)).alias("gap_sum"),
            F.least(F.min("low"), F.min("gap"), F.when(F.sum("repeats") > 0, zero)).alias("gap_min"),
            F.greatest(F.max("high"), F.max("gap"), F.when(F.sum("repeats") > 0, zero)).alias("gap_max"),
        )
        .filter(F.col("gap_count") > 0)
    )


def _gap(start: Column, end: Column, digits: int) -> Column:
    return rounded(days_between(start, end), digits).cast(f"decimal(18,{digits})")


def second_order_within(orders: DataFrame, customer: str, ts: str, days: int) -> DataFrame:
    """Per customer: first order time, when the next day with orders began, whether more than one
    order fell on the first day, and whether another order followed within ``days`` days."""
    daily = daily_activity(orders, customer, ts)
    by_day = W.partitionBy(customer).orderBy("day")
    ranked = daily.select(
        customer,
        "first_ts",
        F.col("orders"),
        F.row_number().over(by_day).alias("_n"),
        F.lead("first_ts").over(by_day).alias("next_ts"),
    ).filter(F.col("_n") == 1)
    followed = (F.col("orders") > 1) | F.coalesce(
        days_between("first_ts", "next_ts") <= F.lit(float(days)), F.lit(False)
    )
    same_day = (F.col("orders") > 1).alias("same_day")
    return ranked.select(customer, "first_ts", "next_ts", same_day, followed.cast("int").alias("has_second_order"))
