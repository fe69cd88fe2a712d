"""Customer risk table, audiences and the executive screens built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from keepwell.functions.exprs import as_column, ratio, rounded
from keepwell.functions.rules import risk_tier
from keepwell.plans.playbook import recommend


def risk_table(
    features: DataFrame, probability: str | Column, segments: DataFrame | None = None
) -> DataFrame:
    """One row per customer for the CRM, riskiest and then biggest spenders first.

    The tier follows the rounded probability.  ``segments`` may bring
    cluster_segment and rfm_segment by customer_unique_id.
    """
    scored = features.withColumn("_p", rounded(as_column(probability), 4))
    if segments is not None:
        labels = ["cluster_segment", "rfm_segment"]
        known = [c for c in labels if c in segments.columns]
        scored = scored.join(
            segments.select("customer_unique_id", *known), "customer_unique_id", "left"
        )
    else:
        known = []
    for name in ("cluster_segment", "rfm_segment"):
        value = F.coalesce(F.col(name), F.lit("Standard")) if name in known else F.lit("Standard")
        scored = scored.withColumn(name, value)
    return scored.select(
        "customer_unique_id",
        F.col("customer_unique_id").alias("customer_id"),
        F.col("_p").alias("churn_probability"),
        risk_tier("_p").alias("risk_tier"),
        F.col("cluster_segment").alias("segment"),
        "rfm_segment",
        rounded("monetary_total", 2).alias("lifetime_value"),
        rounded("recency_days", 1).alias("recency"),
        F.col("order_frequency").cast("bigint").alias("frequency"),
        rounded("avg_order_value", 2).alias("avg_order_value"),
    ).orderBy(F.desc("churn_probability"), F.desc("lifetime_value"), "customer_unique_id")


def audience(
    risk: DataFrame,
    tiers: Sequence[str] | None = None,
    segment: str | None = None,
    min_spend: float = 0.0,
) -> DataFrame:
    """The rows a campaign is sent to; a filter that is not given does not apply."""
    chosen = risk.filter(F.col("lifetime_value") >= min_spend)
    if tiers and "All" not in tiers:
        chosen = chosen.filter(F.col("risk_tier").isin(*tiers))
    if segment and segment != "All":
        chosen = chosen.filter(F.col("segment") == segment)
    return chosen


def customer_report(
    scored: DataFrame,
    customer: str | int | None = None,
    probability: str = "probability_raw",
    factors: str | None = None,
    segment: str | None = None,
) -> DataFrame:
    """Score sheet per customer: tier (from the unrounded probability), factors, recommendation.

    All customers, or one when ``customer`` is given.  Column names fall back
    the way single records do: cluster segment, RFM segment, "Standard".
    """

    def first_of(names: Sequence[str], default: Column) -> Column:
        present = [F.col(n) for n in names if n in scored.columns]
        return F.coalesce(*present, default)

    rows = scored if customer is None else scored.filter(F.col("customer_unique_id") == customer)
    lead = (
        F.coalesce(
            F.concat(F.col(factors)[0]["feature"], F.lit(" ("), F.col(factors)[0]["direction"], F.lit(")")),
            F.lit("High inactivity"),
        )
        if factors
        else F.lit("High inactivity")
    )
    names = [segment] if segment else ["cluster_segment", "rfm_segment"]
    sheet = rows.select(
        F.col("customer_unique_id").alias("customer_id"),
        "customer_unique_id",
        F.col(probability).alias("_raw"),
        rounded(probability, 4).alias("churn_probability"),
        risk_tier(probability).alias("risk_tier"),
        first_of(names, F.lit("Standard")).alias("segment"),
        first_of(["monetary_total", "monetary"], F.lit(0.0)).cast("double").alias("lifetime_value"),
        first_of(["recency_days", "recency"], F.lit(0.0)).cast("double").alias("recency"),
        first_of(["order_frequency", "frequency"], F.lit(1)).cast("bigint").alias("frequency"),
        *([F.col(factors).alias("important_factors")] if factors else []),
        lead.alias("lead_factor"),
    )
    return recommend(sheet, probability="_raw", factor="lead_factor").drop("_raw")


# -- screens -----------------------------------------------------------------

def exec_kpis(monthly: DataFrame, risk: DataFrame) -> DataFrame:
    """Headline numbers; zeros when there is nothing to count."""
    sales = monthly.agg(
        F.coalesce(F.sum(F.col("net_revenue").cast("decimal(28,2)")), F.lit(0)).cast("double").alias("total_revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("total_orders"),
    )
    people = risk.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("churn_probability") >= 0.5).alias("likely"),
        F.count_if(F.col("risk_tier") == "HIGH").alias("high_risk_customers"),
        F.count_if(F.col("frequency") > 1).alias("repeat"),
    )
    zero = F.lit(0.0)
    return (
        sales.withColumn("_people", people.select(F.struct("*")).scalar())
        .select("total_revenue", "total_orders", "_people.*")
        .select(
            "total_revenue",
            "total_orders",
            "total_customers",
            rounded(F.coalesce(ratio("total_revenue", "total_orders"), zero), 2).alias("avg_order_value"),
            rounded(F.coalesce(ratio("likely", "total_customers"), zero) * 100.0, 2).alias("churn_rate_pct"),
            "high_risk_customers",
            rounded(F.coalesce(ratio("repeat", "total_customers"), zero) * 100.0, 2).alias("repeat_rate_pct"),
        )
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """value, customers, most frequent first."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "value")
    )


def segment_cards(segments: DataFrame, segment: str = "cluster_segment") -> DataFrame:
    """Per segment: customers, share, mean spend, recency and orders."""
    cards = segments.groupBy(F.col(segment).alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"),
        *[
            rounded(ratio(F.sum(F.col(c).cast("decimal(28,2)")), F.count(c)), 2).alias(f"avg_{c}")
            for c in ("monetary", "recency", "frequency")
        ],
    )
    total = F.sum("customers").over(W.partitionBy(F.lit(0)))  # one row per segment
    return cards.withColumn("share_pct", rounded(ratio("customers", total) * 100.0, 1)).orderBy("segment")
