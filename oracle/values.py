"""Fixed values the SQL is held against, stated here so that a wrong one in the library shows.

Rules are (condition, label), the first that holds wins.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
FEATURES = [
    "recency_days",
    "order_frequency",
    "monetary_total",
    "avg_order_value",
    "total_quantity",
    "customer_tenure_days",
    "avg_freight_value",
    "freight_ratio",
    "category_diversity",
    "avg_review_score",
    "cancelled_orders_cnt",
    "credit_card_share",
    "avg_installments",
    "last_30d_orders",
    "last_60d_orders",
    "spending_trend_velocity",
    "avg_delivery_delay_days",
]
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
HIGH_VALUE_TERMS = [
    "champions",
    "vip",
    "loyal",
    "at-risk high-value",
]
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


def evenly(start: float, stop: float, count: int) -> list[float]:
    """Evenly spaced thresholds, both ends included."""
    return [start + i * ((stop - start) / (count - 1)) for i in range(count - 1)] + [stop]
