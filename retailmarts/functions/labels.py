"""Labels and flags derived from single rows."""

from __future__ import annotations

# Statuses, payment labels, seller tiers and delivery grades.
VALID_STATUSES = [
    "delivered", "shipped", "canceled", "invoiced", "processing", "unavailable", "created", "approved",
]
PAYMENT_LABELS = {
    "credit_card": "Credit Card",
    "boleto": "Boleto",
    "voucher": "Voucher",
    "debit_card": "Debit Card",
}
TIERS = [(50_000, "Platinum"), (10_000, "Gold"), (1_000, "Silver")]
LOWEST_TIER = "Bronze"
GRADES = [(5, "Excellent"), (15, "Good"), (25, "Needs Improvement")]
LOWEST_GRADE = "Poor"


def listed(values) -> str:
    """Values as the inside of an SQL list."""
    return ", ".join(f"'{v}'" for v in values)


def delay_days(delivered: str, estimated: str) -> str:
    """Whole days late, rounded down: one second early is −1, 23:59:59 late is 0."""
    return f"floor((unix_timestamp({delivered}) - unix_timestamp({estimated})) / 86400)"


def payment_label(kind: str) -> str:
    cases = " ".join(f"WHEN '{raw}' THEN '{shown}'" for raw, shown in PAYMENT_LABELS.items())
    return f"CASE {kind} {cases} ELSE coalesce({kind}, 'Unknown') END"


def category_label(english: str, original: str) -> str:
    """English category, else the original one, else ``unknown``; blanks are skipped."""
    return f"coalesce(nullif({english}, ''), nullif({original}, ''), 'unknown')"


def seller_tier(revenue: str) -> str:
    """Tier by revenue; an unknown revenue is the lowest tier."""
    cases = " ".join(f"WHEN {revenue} >= {least} THEN '{name}'" for least, name in TIERS)
    return f"CASE {cases} ELSE '{LOWEST_TIER}' END"


def delivery_grade(late_pct: str) -> str:
    """Grade by the rounded late percentage; an unknown percentage is the lowest grade."""
    cases = " ".join(f"WHEN {late_pct} <= {most} THEN '{name}'" for most, name in GRADES)
    return f"CASE {cases} ELSE '{LOWEST_GRADE}' END"
