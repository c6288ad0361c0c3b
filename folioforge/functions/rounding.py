"""Rounding and summing that do not depend on the order in which partitions are merged."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Decimals that exact sums keep, and that rounding looks at: far below the digits of any result, above binary noise.
EXACT, READ = "decimal(38,12)", "decimal(38,11)"
LOSS = 1e-10  # share of a value that its decimal may lose


def stable_round(col: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of a double, read to eleven decimals.

    What lies beyond is the binary noise of a product such as 10 * 0.1235, which must not decide a tie. NaN and
    values too large for that are rounded as they are.
    """
    return F.coalesce(F.round(col.try_cast(READ), digits).cast("double"), F.round(col, digits))


def _exact(col: Column) -> Column:
    """The value as a decimal; null where it does not fit or would lose more than LOSS of itself."""
    exact, plain = col.try_cast(EXACT), col.cast("double")
    return F.when(F.abs(exact.cast("double") - plain) <= F.abs(plain) * LOSS, exact)


def sum_parts(col: Column, name: str) -> list[Column]:
    """Partial sums of a column that :func:`sum_of_parts` puts together over any coarser grouping."""
    exact = _exact(col)
    return [
        F.when(F.count(exact) == F.count(col), F.try_sum(exact)).alias(f"{name}_exact"),
        F.sum(col.cast("double")).alias(f"{name}_plain"),
    ]


def merged_parts(name: str) -> list[Column]:
    """Partial sums of partial sums, under the same names, for states that are merged again later."""
    exact, plain = F.col(f"{name}_exact"), F.col(f"{name}_plain")
    return [
        F.when(F.count(exact) == F.count(plain), F.try_sum(exact)).cast("decimal(38,12)").alias(f"{name}_exact"),
        F.sum(plain).alias(f"{name}_plain"),
    ]


def sum_of_parts(name: str) -> Column:
    exact, plain = F.col(f"{name}_exact"), F.col(f"{name}_plain")
    whole = F.when(F.count(exact) == F.count(plain), F.try_sum(exact).cast("double"))
    return F.coalesce(whole, F.sum(plain))


def exact_sum(col: Column) -> Column:
    """Sum of a double, the same in any order, where decimals of twelve places hold the values.

    Where one of them does not fit, or is so small that the decimal would lose digits of it, doubles are summed.
    """
    exact = _exact(col)
    whole = F.when(F.count(exact) == F.count(col), F.try_sum(exact).cast("double"))
    return F.coalesce(whole, F.sum(col.cast("double")))


def exact_mean(col: Column) -> Column:
    """Mean built on :func:`exact_sum`; null when there is no value."""
    return F.try_divide(exact_sum(col), F.count(col))
