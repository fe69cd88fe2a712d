"""Which retention action a customer gets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from keepwell.functions.exprs import as_column, rounded
from keepwell.functions.rules import is_high_value

# --- fixed values: the six plays --------------------------------------------
# Placeholders: {spend} money, {risk} percentage, {days} whole days, {factor} text.
PLAYS = [
    {
        "play": "value_high",
        "action_title": "VIP Priority Intervention & Concierge Outreach",
        "strategy": "Customer has generated high cumulative revenue (${spend}) but shows critical churn risk ({risk}). Immediate proactive intervention required: Assign dedicated concierge agent, dispatch an executive appreciation note with a margin-safe retention credit ($30-$40), and audit delivery friction ({factor}).",
        "recommended_budget": "$30 - $45",
        "delivery_channel": "Direct Account Specialist Email / Priority WhatsApp",
        "operational_urgency": "URGENT (Action within 48 Hours)",
    },
    {
        "play": "value_medium",
        "action_title": "Proactive VIP Relationship Nurturing",
        "strategy": "High-value customer (${spend}) showing moderate inactivity ({days} days). Incentivize reactivation via exclusive early access to top category restocks and complimentary freight subsidy on their next order.",
        "recommended_budget": "$15 - $25",
        "delivery_channel": "Personalized VIP Newsletter & SMS",
        "operational_urgency": "Moderate (Within 7 Days)",
    },
    {
        "play": "value_low",
        "action_title": "Brand Loyalty Amplification & Referral",
        "strategy": "Highly engaged, low-risk customer. Maximize retention and lifetime value through loyalty club invitations, tiered rewards, and peer referral incentives. Do not offer margin-diluting discounts.",
        "recommended_budget": "$5 - $10",
        "delivery_channel": "In-App Loyalty Portal & Email",
        "operational_urgency": "Scheduled Quarterly",
    },
    {
        "play": "other_high",
        "action_title": "Automated Digital Win-Back Sequence",
        "strategy": "Lower spending customer (${spend}) with high churn risk ({risk}). Manual high-touch outreach is not ROI-positive. Enroll into automated 3-stage drip email workflow featuring category-specific recommendations and an expiring 10% coupon on orders above $30.",
        "recommended_budget": "$1 - $3 (Automated digital)",
        "delivery_channel": "Automated Marketing Automation (Email/Push)",
        "operational_urgency": "Automated System Trigger",
    },
    {
        "play": "other_medium",
        "action_title": "Cross-Category Discovery & Re-Engagement",
        "strategy": "Customer purchase cadence is slowing down ({days} days since order). Trigger algorithmic recommendations of trending products in complementary categories with high review ratings.",
        "recommended_budget": "$0.50 - $1.50",
        "delivery_channel": "Dynamic Recommendation Email",
        "operational_urgency": "Bi-Weekly Marketing Cycle",
    },
    {
        "play": "other",
        "action_title": "Standard Nurture & Organic Engagement",
        "strategy": "Stable behavioral profile with low churn risk ({risk}). Maintain standard organic engagement, seasonal product drops, and educational content. No intervention cost required.",
        "recommended_budget": "$0.00 (Organic)",
        "delivery_channel": "Standard Weekly Newsletter",
        "operational_urgency": "Routine Cadence",
    },
]
# --- end of fixed values ----------------------------------------------------

_TEXTS = ["action_title", "strategy", "recommended_budget", "delivery_channel", "operational_urgency"]


def _number(value: Column, digits: int, grouped: bool) -> Column:
    pattern = f"%,.{digits}f" if grouped else f"%.{digits}f"
    return F.format_string(pattern, rounded(value, digits))


def recommend(
    customers: DataFrame,
    segment: str = "segment",
    tier: str = "risk_tier",
    probability: str = "churn_probability",
    spend: str = "lifetime_value",
    recency: str = "recency",
    factor: str | Column | None = None,
) -> DataFrame:
    """Adds is_high_value and the five texts of the play that applies.

    The six plays are a tiny table looked up by (value, tier); unknown tiers
    fall to the last play.
    """
    valued = F.coalesce(is_high_value(segment, spend), F.lit(False))
    level = as_column(tier)
    play = (
        F.when(valued & level.isin("HIGH", "MEDIUM", "LOW"), F.concat(F.lit("value_"), F.lower(level)))
        .when(~valued & level.isin("HIGH", "MEDIUM"), F.concat(F.lit("other_"), F.lower(level)))
        .otherwise("other")
    )
    plays = F.create_map(
        *[
            x
            for p in PLAYS
            for x in (F.lit(p["play"]), F.struct(*[F.lit(p[t]).alias(t) for t in _TEXTS]))
        ]
    )
    chosen = F.element_at(plays, play)
    fill = {
        "{spend}": _number(as_column(spend), 2, grouped=True),
        "{risk}": F.concat(_number(as_column(probability) * 100, 1, grouped=False), F.lit("%")),
        "{days}": _number(as_column(recency), 0, grouped=False),
        "{factor}": F.lit("") if factor is None else as_column(factor),
    }
    out = customers.withColumn("_play", chosen)
    strategy = F.col("_play.strategy")
    for mark, text in fill.items():
        strategy = F.replace(strategy, F.lit(mark), F.coalesce(text, F.lit("")))
    return out.select(
        *customers.columns,
        valued.alias("is_high_value"),
        *[(strategy if t == "strategy" else F.col(f"_play.{t}")).alias(t) for t in _TEXTS],
    )
