"""Exact quantiles, moments and outlier counts of many columns in two scans.

The first scan is one aggregate over the wide rows: counts, moments and a sketch per column. Its quantiles a few rank errors
below and above each wanted rank give brackets that hold the wanted values, and with them the fences. The second scan counts
values per gap between brackets and keeps them apart inside, so what is shuffled is a handful of counts and the narrow
brackets. Ranks are found from those counts; whether a bracket holds its rank is checked, not assumed. A column whose sketch
missed is done again by :func:`exact_quantiles`.

Missing values and NaN are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioforge.functions.rounding import sum_of_parts, sum_parts
from folioforge.operators.quantiles import exact_quantiles
from folioforge.session import cut_lineage, literal_frame

ACCURACY = 50_000
REACH = 3  # rank errors of the sketch on either side of a wanted rank
MOMENTS = {
    "mean": F.mean,
    "std": F.stddev_samp,
    "g1": F.skewness,
    "g2": F.kurtosis,
    "min": F.min,
    "max": F.max,
}


@dataclass
class ColumnProfile:
    """What the two scans tell about one column."""

    n: int = 0
    moments: dict[str, float | None] = field(default_factory=dict)
    quantiles: list[float | None] = field(default_factory=list)
    fences: tuple[float, float] | None = None
    outliers: int = 0
    capped_sum: float | None = None


def number(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def first_scan(df: DataFrame, columns: Sequence[str], probs: Sequence[float], moments: bool) -> tuple[list[ColumnProfile], list[list]]:
    """Profiles with counts and moments, and the bracket of each wanted rank."""
    wanted = [min(1.0, max(0.0, p + side * REACH / ACCURACY)) for p in probs for side in (-1, 1)]
    parts = []
    for i, c in enumerate(columns):
        parts += [F.count(number(c)).alias(f"n{i}"), F.percentile_approx(number(c), wanted, ACCURACY).alias(f"cuts{i}")]
        parts += [fn(number(c)).alias(f"{name}{i}") for name, fn in (MOMENTS.items() if moments else ())]
    row = df.agg(*parts).first()
    profiles = [
        ColumnProfile(row[f"n{i}"], {name: row[f"{name}{i}"] for name in (MOMENTS if moments else ())}) for i in range(len(columns))
    ]
    cuts = [row[f"cuts{i}"] or [] for i in range(len(columns))]
    return profiles, [list(zip(c[::2], c[1::2])) for c in cuts]


def approx_profile(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], fence_factor: float | None = None
) -> dict[str, ColumnProfile]:
    """Counts, moments and the sketch's own quantiles (and fences) after one scan."""
    parts = []
    for i, c in enumerate(columns):
        parts += [F.count(number(c)).alias(f"n{i}"), F.percentile_approx(number(c), list(probs), ACCURACY).alias(f"q{i}")]
        parts += [fn(number(c)).alias(f"{name}{i}") for name, fn in MOMENTS.items()]
    row, out = df.agg(*parts).first(), {}
    for i, c in enumerate(columns):
        p = out[c] = ColumnProfile(row[f"n{i}"], {name: row[f"{name}{i}"] for name in MOMENTS}, row[f"q{i}"] or [None] * len(probs))
        if p.n and fence_factor is not None:
            reach = (p.quantiles[-1] - p.quantiles[0]) * fence_factor
            p.fences = (p.quantiles[0] - reach, p.quantiles[-1] + reach)
    return out


def fence_brackets(low: tuple[float, float], high: tuple[float, float], factor: float) -> list[tuple[float, float]]:
    """Where the fences can lie when the quartiles lie in these brackets."""
    (a1, b1), (a3, b3) = low, high
    least, most = max(0.0, a3 - b1) * factor, (b3 - a1) * factor
    # A little wider than computed, so that rounding of the exact fence cannot leave it.
    slack = 1e-9 * (abs(a1) + abs(b3) + most)
    return [(a1 - most - slack, b1 - least + slack), (a3 + least - slack, b3 + most + slack)]


def disjoint(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Brackets in order, those that meet put together."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def place(value: Column, brackets: Sequence[tuple[float, float]]) -> Column:
    """2i + 1 inside bracket i, 2i in the gap before it; null without a value."""
    out = F.when(value.isNull(), F.lit(None).cast("int"))
    for i, (low, high) in enumerate(brackets):
        out = out.when(value < low, 2 * i).when(value <= high, 2 * i + 1)
    return out.otherwise(2 * len(brackets))


def second_scan(df: DataFrame, columns: Sequence[str], brackets: Sequence[Sequence[tuple[float, float]]], sums: bool) -> DataFrame:
    """(col, place, value, rows): values inside brackets, one row per gap for the others; ``value`` is null for gaps."""
    cells = []
    for i, c in enumerate(columns):
        at, x = place(number(c), brackets[i]), number(c)
        cells.append(F.struct(F.lit(i).alias("col"), at.alias("place"), F.when(at % 2 == 1, x).alias("value"), x.alias("x")))
    long = df.select(F.inline(F.array(*cells))).where("place IS NOT NULL")
    counts = [F.count(F.lit(1)).alias("rows"), *(sum_parts(F.col("x"), "x") if sums else [])]
    return cut_lineage(long.groupBy("col", "place", "value").agg(*counts))


def values_at(narrow: DataFrame, wanted: Sequence[tuple[int, int, int]]) -> dict[tuple[int, int, int], float]:
    """Values at (col, place, rank inside that place); places are as many as brackets, so nothing large is collected."""
    if not wanted:
        return {}
    ranks = literal_frame(narrow.sparkSession, list(wanted), "col int, place int, rank bigint")
    end = F.sum("rows").over(Window.partitionBy("col", "place").orderBy("value"))
    placed = narrow.where("place % 2 = 1").select("col", "place", "value", "rows", end.alias("end"))
    met = placed.join(F.broadcast(ranks), ["col", "place"]).where("rank < end AND rank >= end - rows")
    return {(r["col"], r["place"], r["rank"]): r["value"] for r in met.collect()}


def wide_profile(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    moments: bool = False,
    fence_factor: float | None = None,
    sums: bool = False,
) -> dict[str, ColumnProfile]:
    """Profiles by column. With ``fence_factor`` the first and last of ``probs`` are the quartiles that fences and outliers
    come from, and ``sums`` adds the sum after clipping to the fences."""
    profiles, ranges = first_scan(df, columns, probs, moments)
    brackets = []
    for own in ranges:
        extra = fence_brackets(own[0], own[-1], fence_factor) if own and fence_factor is not None else []
        every = [*own, *extra]
        brackets.append(disjoint(every) if all(map(math.isfinite, sum(every, ()))) else [])
    counted = second_scan(df, columns, brackets, sums)
    totals: list[dict[int, int]] = [{} for _ in columns]
    for r in counted.groupBy("col", "place").agg(F.sum("rows").alias("rows")).collect():  # a few rows per column
        totals[r["col"]][r["place"]] = r["rows"]

    need, lacking = {}, set()
    for i, p in enumerate(profiles):
        starts, before = {}, 0
        for at in sorted(totals[i]):
            starts[at], before = before, before + totals[i][at]
        for prob in probs if p.n else ():
            for rank in {math.floor(prob * (p.n - 1)), math.ceil(prob * (p.n - 1))}:
                at = max(a for a, start in starts.items() if start <= rank)
                need[i, rank] = (i, at, rank - starts[at])
                if at % 2 == 0:
                    lacking.add(i)
    found = values_at(counted, sorted({key for (i, _), key in need.items() if i not in lacking}))
    for i, (c, p) in enumerate(zip(columns, profiles)):
        if not p.n:
            p.quantiles = [None] * len(probs)
        elif i in lacking:
            p.quantiles = list(exact_quantiles(df, [c], probs).first()["q"])
        else:
            for prob in probs:
                h = float(prob) * (p.n - 1)
                low, high = (found[need[i, k(h)]] for k in (math.floor, math.ceil))
                p.quantiles.append(low + (high - low) * (h - math.floor(h)))
    if fence_factor is not None:
        _outside(df, columns, profiles, brackets, counted, fence_factor, sums)
    return dict(zip(columns, profiles))


def _outside(df, columns, profiles, brackets, counted: DataFrame, factor: float, sums: bool) -> None:
    """Fences, outliers and clipped sums, from the counted gaps and brackets."""
    rows, again = [], []
    for i, p in enumerate(profiles):
        if not p.n:
            continue
        reach = (p.quantiles[-1] - p.quantiles[0]) * factor
        p.fences = (p.quantiles[0] - reach, p.quantiles[-1] + reach)
        at = [next((2 * k + 1 for k, (a, b) in enumerate(brackets[i]) if a <= f <= b), None) for f in p.fences]
        if None in at:
            again.append(i)  # no bracket holds the fence
        else:
            rows.append((i, *p.fences, *at))
    for i in again:
        low, high, x = *profiles[i].fences, number(columns[i])
        clipped = F.greatest(F.least(x, F.lit(high)), F.lit(low))
        parts = df.where(x.isNotNull()).agg(F.count_if((x < low) | (x > high)).alias("n"), *sum_parts(clipped, "x"))
        r = parts.groupBy().agg(F.first("n").alias("n"), sum_of_parts("x").alias("x")).first()
        profiles[i].outliers, profiles[i].capped_sum = r["n"], r["x"]
    if not rows:
        return
    fences = F.broadcast(literal_frame(df.sparkSession, rows, "col int, low double, high double, at_low int, at_high int"))
    inside = F.col("place") % 2 == 1
    below = F.when(inside, F.col("value") < F.col("low")).otherwise(F.col("place") < F.col("at_low"))
    above = F.when(inside, F.col("value") > F.col("high")).otherwise(F.col("place") > F.col("at_high"))
    side = F.when(below, -1).when(above, 1).otherwise(0)
    parts = [F.sum("rows").alias("rows"), *([sum_of_parts("x").alias("x")] if sums else [])]
    for r in counted.join(fences, "col").groupBy("col", side.alias("side")).agg(*parts).collect():  # three rows per column
        p = profiles[r["col"]]
        p.outliers += r["rows"] if r["side"] else 0
        if sums:
            p.capped_sum = (p.capped_sum or 0.0) + (r["rows"] * p.fences[r["side"] > 0] if r["side"] else r["x"])
