"""Numeric coercion and price features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioforge.functions.rounding import stable_round
from folioforge.functions.text import trimmed

# Fixed values.
BESTSELLER_RATING = 4.5
HIGH_RATING = 4.0
FIXED_GBP_RATE = 0.79


def to_number(col: Column) -> Column:
    """Text to double; anything that does not parse is null."""
    return trimmed(col.cast("string")).try_cast("double")


def money_to_number(col: Column) -> Column:
    """As :func:`to_number`, after the ``$`` and ``,`` marks are dropped."""
    return to_number(F.regexp_replace(col.cast("string"), "[$,]", ""))


def at_least_zero(col: Column) -> Column:
    """Clip below at zero; null stays null (``greatest`` would turn it into zero)."""
    return F.when(col < 0, F.lit(0.0)).otherwise(col)


def discount_amount(old_price: Column, price: Column, clipped: bool = True) -> Column:
    diff = old_price - price
    return stable_round(at_least_zero(diff) if clipped else diff, 2)


def discount_pct(amount: Column, old_price: Column) -> Column:
    """Percent of the old price; 0 when the old price is zero or missing."""
    return F.coalesce(stable_round(F.try_divide(amount, old_price) * 100, 2), F.lit(0.0))


def convert(price: Column, rate: Column | float = FIXED_GBP_RATE) -> Column:
    return stable_round(price * rate, 2)


def value_score(rating: Column, price: Column) -> Column:
    """Rating per unit of price; 0 when the price is zero or either side is missing."""
    return F.coalesce(stable_round(F.try_divide(rating, price), 4), F.lit(0.0))


def popularity_score(rating: Column, votes: Column) -> Column:
    return stable_round(rating * F.log1p(at_least_zero(votes)), 3)


def decade(year: Column) -> Column:
    """1995 becomes ``1990s``."""
    return F.concat((F.floor(year / 10) * 10).cast("int").cast("string"), F.lit("s"))
