"""Risk tiers, value segments and the texts that go with them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Actions and strategies per risk tier, and recommendations per segment.
CANCELLATION_ACTIONS = {
    "Low": ["Standard confirmation email", "No special measures required", "Regular follow-up"],
    "Medium": [
        "Send reminder email 1 week before arrival",
        "Offer room upgrade if available",
        "Highlight cancellation policy in communications",
    ],
    "High": [
        "Call to confirm reservation",
        "Consider overbooking strategy",
        "Offer incentives to prevent cancellation",
        "Request partial prepayment or deposit",
    ],
}
CHURN_STRATEGIES = {"Low": "Regular Maintenance", "Medium": "Proactive Retention", "High": "Urgent Intervention"}
CHURN_ACTIONS = {
    "Low": ["Regular marketing communications", "Standard loyalty program", "Periodic satisfaction surveys"],
    "Medium": [
        "Personalized offers for next stay",
        "Enhanced loyalty benefits",
        "Direct outreach before typical booking window",
        "Special amenities on next stay",
    ],
    "High": [
        "Immediate win-back campaign",
        "Significant discount or upgrade offer",
        "Personal call from hotel manager",
        "Investigate any negative experiences",
        "Premium loyalty incentives",
    ],
}
SEGMENT_RECOMMENDATIONS = {
    "High-Value High-Risk": [
        "Send personalized win-back offers",
        "Offer room upgrades on next stay",
        "Provide dedicated customer service",
        "Implement regular check-ins from hotel manager",
        "Offer loyalty program benefits without full membership",
    ],
    "Low-Value High-Risk": [
        "Send targeted promotional offers",
        "Offer discounts for off-peak periods",
        "Invite to join loyalty program with sign-up incentive",
        "Implement satisfaction surveys to address concerns",
        "Provide special amenities on next stay",
    ],
    "High-Value Medium-Risk": [
        "Implement preemptive loyalty rewards",
        "Offer early check-in/late check-out",
        "Send personalized communications about hotel updates",
        "Provide anniversary or birthday special offers",
        "Create exclusive VIP events",
    ],
    "Low-Value Medium-Risk": [
        "Offer upsell packages to increase value",
        "Implement automated follow-up emails",
        "Provide targeted promotions for longer stays",
        "Offer discounts for direct bookings",
        "Create budget-friendly loyalty incentives",
    ],
    "High-Value Loyal": [
        "Implement recognition programs",
        "Offer premium loyalty benefits",
        "Create exclusive experiences",
        "Provide surprise upgrades",
        "Implement personalized concierge service",
    ],
    "Low-Value Loyal": [
        "Offer gradual loyalty incentives",
        "Implement referral programs",
        "Provide small recognition gestures",
        "Create seasonal special offers",
        "Offer package deals to increase value",
    ],
}


def risk_level(probability: str) -> Column:
    """Below 0.3 Low, below 0.7 Medium, otherwise High."""
    p = F.col(probability)
    return F.when(p < 0.3, "Low").when(p < 0.7, "Medium").when(p.isNotNull(), "High")


def high_risk(probability: str) -> Column:
    return F.col(probability) > 0.5


def value_segment(value: str, threshold: float) -> Column:
    """At or above the threshold is high value."""
    return F.when(F.col(value) >= F.lit(threshold), "High Value").otherwise("Standard Value")


def risk_value_segment(probability: str, value: str, threshold: float) -> Column:
    """Six segments. Both borders belong to the lower side: exactly 0.7 is medium, exactly the threshold is low."""
    worth = F.when(F.col(value) > F.lit(threshold), "High-Value").otherwise("Low-Value")
    risk = (
        F.when(F.col(probability) > 0.7, "High-Risk").when(F.col(probability) > 0.3, "Medium-Risk").otherwise("Loyal")
    )
    return F.concat_ws(" ", worth, risk)


def lookup(key: Column, texts: dict[str, object]) -> Column:
    """Value of a fixed dictionary for a key column, null when the key is unknown."""
    pairs = []
    for name, content in texts.items():
        pairs.append(F.lit(name))
        pairs.append(F.array(*[F.lit(t) for t in content]) if isinstance(content, list) else F.lit(content))
    return F.try_element_at(F.create_map(*pairs), key)
