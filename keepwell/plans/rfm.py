"""Recency, frequency, monetary scores and segments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.exprs import instant, not_excluded, rounded, rounded_days
from keepwell.functions.rules import RFM_NTILE_RULES, RFM_RULES, first_match
from keepwell.operators.ordering import ntile_ends, quantile_bins, quantile_ends
from keepwell.operators.selection import moments_and_quantiles
from keepwell.plans.revenue import net_revenue, per_order
from keepwell.session import materialize
from keepwell.settings import (
    INACTIVE_STATUSES,
    LEGACY_INACTIVE_STATUSES,
    RFM_CUTOFF,
    RFM_NTILE_CUTOFF,
)


def rfm_values(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    cutoff: str,
    customer: str = "customer_unique_id",
    amount: Column | None = None,
    recency_digits: int = 1,
    keep: Column | None = None,
) -> DataFrame:
    """customer, latest_order, frequency, monetary, recency strictly before the cutoff.

    Orders without items do not count.
    """
    keep = not_excluded("order_status", INACTIVE_STATUSES) if keep is None else keep
    totals = per_order(items, spend=F.col("price") if amount is None else amount)
    ids = list(dict.fromkeys(["customer_id", customer]))
    recency = rounded_days("latest_order", instant(cutoff), recency_digits)
    return (
        orders.filter((F.col("order_purchase_timestamp") < instant(cutoff)) & keep)
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(totals, "order_id")
        .join(customers.select(*ids), "customer_id")
        .groupBy(customer)
        .agg(
            F.max("order_purchase_timestamp").alias("latest_order"),
            F.count_distinct("order_id").alias("frequency"),
            rounded(F.coalesce(F.sum("spend"), F.lit(0)), 2).alias("monetary"),
        )
        .withColumn("recency", recency)
    )


def score(
    values: DataFrame,
    customer: str,
    ends: Callable[[int, int], list[int]],
    rules: Sequence[tuple[str, str]],
) -> DataFrame:
    """Adds r/f/m scores 1..5 (5 is best), the combined score and the segment."""
    scored = quantile_bins(
        materialize(values),
        {
            "r_score": -F.col("recency"),
            "f_score": F.col("frequency"),
            "m_score": F.col("monetary"),
        },
        customer,
        5,
        ends,
    )
    return scored.withColumn(
        "rfm_score", F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score")
    ).withColumn("rfm_segment", first_match(rules))


def rfm(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    cutoff: str = RFM_CUTOFF,
    rules: Sequence[tuple[str, str]] = RFM_RULES,
) -> DataFrame:
    """Quintiles of the row number (ties by id), cut at the row numbers' own quantiles."""
    values = rfm_values(orders, items, customers, cutoff)
    return score(values, "customer_unique_id", quantile_ends, rules)


def rfm_ntile(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    cutoff: str = RFM_NTILE_CUTOFF,
    rules: Sequence[tuple[str, str]] = RFM_NTILE_RULES,
) -> DataFrame:
    """NTILE quintiles on net revenue and whole-day recency, largest spenders first."""
    values = rfm_values(
        orders,
        items,
        customers,
        cutoff,
        customer="customer_id",
        amount=net_revenue(),
        recency_digits=0,
        keep=~F.col("order_status").isin(*LEGACY_INACTIVE_STATUSES),
    ).withColumn("recency", F.col("recency").cast("int"))
    return (
        score(values, "customer_id", ntile_ends, rules)
        .drop("latest_order")
        .orderBy(F.desc("monetary"), "customer_id")
    )


def describe(scored: DataFrame, columns: Sequence[str] = ("recency", "frequency", "monetary")) -> DataFrame:
    """measure, count, mean, std, min, p25, p50, p75, max: exact, over any number of rows."""
    found = moments_and_quantiles(scored, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return found.select(
        "measure",
        F.col("n").alias("count"),
        rounded("mean", 4).alias("mean"),
        rounded("std", 4).alias("std"),
        F.col("low").alias("min"),
        *[rounded(c, 4).alias(c) for c in ("p25", "p50", "p75")],
        F.col("high").alias("max"),
    )
