"""First-match rule lists as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from keepwell.functions.exprs import as_column
from keepwell.settings import HIGH_RISK, MEDIUM_RISK

# --- fixed values: condition and label, the first that holds wins -----------
RFM_RULES = [
    ("r_score >= 4 AND f_score >= 4 AND m_score >= 4", "Champions"),
    ("r_score >= 3 AND f_score >= 3", "Loyal Customers"),
    ("r_score >= 4 AND f_score <= 2", "New / Promising"),
    ("r_score <= 2 AND f_score >= 3 AND m_score >= 3", "At-Risk High-Value"),
    ("r_score <= 2 AND m_score >= 4", "At-Risk Spenders"),
    ("r_score >= 3 AND f_score <= 2", "Potential Loyalists"),
    ("r_score <= 2 AND f_score <= 2", "Hibernating"),
    ("true", "Needs Attention"),
]
RFM_NTILE_RULES = [
    ("r_score >= 4 AND f_score >= 4 AND m_score >= 4", "Champions"),
    ("r_score >= 3 AND f_score >= 3 AND m_score >= 3", "Loyal Customers"),
    ("r_score >= 4 AND f_score <= 2", "Promising / New Customers"),
    ("r_score <= 2 AND f_score >= 3 AND m_score >= 3", "At Risk High-Value"),
    ("r_score <= 2 AND f_score <= 2 AND m_score >= 3", "At Risk Spenders"),
    ("r_score >= 3 AND f_score <= 2 AND m_score <= 2", "Potential Loyalists"),
    ("r_score <= 2 AND f_score <= 2 AND m_score <= 2", "Hibernating / Lost"),
    ("true", "Needs Attention"),
]
RFM_SHORT_RULES = [
    ("r_score >= 4 AND f_score >= 4 AND m_score >= 4", "Champions & VIPs"),
    ("r_score >= 3 AND f_score >= 3", "Loyal Customers"),
    ("r_score >= 4 AND f_score <= 2", "New / Promising"),
    ("r_score <= 2 AND m_score >= 4", "At-Risk High Spenders"),
    ("r_score <= 2 AND f_score <= 2", "Hibernating / Lost"),
    ("true", "Needs Attention"),
]
# clusters, after ranking them by mean spend
CLUSTER_RULES = [
    ("spend_rank = 1", "Champions & High-Value VIPs"),
    ("avg_recency > 180 AND avg_monetary > median_of_means", "At-Risk High Spenders"),
    ("avg_recency <= 150 AND avg_frequency >= 1.5", "Loyal & Consistent"),
    ("true", "Hibernating / One-Time Buyers"),
]
HIGH_VALUE_TERMS = ["champions", "vip", "loyal", "at-risk high-value"]
HIGH_VALUE_SPEND = 300.0
# --- end of fixed values ----------------------------------------------------


def first_match(rules: Sequence[tuple[str, str]]) -> Column:
    """A CASE over SQL conditions."""
    cases = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in rules)
    return F.expr(f"CASE {cases} END")


def risk_tier(probability: str | Column) -> Column:
    p = as_column(probability)
    return F.when(p >= HIGH_RISK, "HIGH").when(p >= MEDIUM_RISK, "MEDIUM").otherwise("LOW")


def is_high_value(segment: str | Column, spend: str | Column) -> Column:
    """Segment name holds a high-value term, or enough spend."""
    name = F.lower(as_column(segment))
    named = [F.coalesce(F.contains(name, F.lit(term)), F.lit(False)) for term in HIGH_VALUE_TERMS]
    rich = F.coalesce(as_column(spend) >= HIGH_VALUE_SPEND, F.lit(False))
    for test in named:
        rich = rich | test
    return rich
