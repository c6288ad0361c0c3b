"""Tier labels: one function, driven by (upper bound, bound included, label) steps."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, functions as F


class Step(NamedTuple):
    upper: float
    inclusive: bool
    label: str


class Tiers(NamedTuple):
    steps: Sequence[Step]
    otherwise: str


# Bounds and labels.
PRICE = Tiers(
    [Step(10, False, "Budget (<$10)"), Step(25, True, "Standard ($10-25)"), Step(50, True, "Premium ($25-50)")],
    "Luxury (>$50)",
)
DISCOUNT = Tiers(
    [Step(0, True, "No Discount"), Step(15, False, "Low (<15%)"), Step(35, True, "Medium (15-35%)")],
    "High (>35%)",
)
PAGES = Tiers(
    [
        Step(100, False, "Short (<100 pages)"),
        Step(300, False, "Medium (100-300)"),
        Step(600, False, "Long (300-600)"),
    ],
    "Comprehensive (600+)",
)
RATING = Tiers(
    [
        Step(3.0, False, "Below Average (<3.0)"),
        Step(4.0, False, "Average (3.0-4.0)"),
        Step(4.5, False, "Good (4.0-4.5)"),
    ],
    "Excellent (4.5+)",
)


def tier(col: Column, tiers: Tiers, when_null: str | None = None) -> Column:
    """Label of the first step whose bound is not passed.

    A missing value compares false with every bound. It takes ``when_null``, or the last label.
    """
    last = tiers.otherwise
    expr = F.when(col.isNull(), last if when_null is None else when_null)
    for step in tiers.steps:
        expr = expr.when((col <= step.upper) if step.inclusive else (col < step.upper), step.label)
    return expr.otherwise(last)


def price_tier(col: Column) -> Column:
    return tier(col, PRICE)


def discount_tier(col: Column) -> Column:
    return tier(col, DISCOUNT)


def page_tier(col: Column) -> Column:
    return tier(col, PAGES)


def rating_category(col: Column) -> Column:
    """A missing rating passes no lower bound, so it lands in the lowest class."""
    return tier(col, RATING, when_null=RATING.steps[0].label)
