"""Exact quantiles and modes that stay distributed.

``percentile`` keeps a value-to-count map of the whole column (or of the whole group) in one task,
so a high-cardinality column or a hot group does not fit. Here a sketch proposes cut points close to
the wanted ranks, one counting pass finds out which interval holds each rank, and only the values of
those narrow intervals are shuffled and sorted. The sketch decides speed only: any cut points give
the exact result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioforge.session import broadcast_if_small, cut_lineage

# Ranks around each wanted quantile, in units of the sketch's error, at which cuts are placed.
CUT_OFFSETS = (-3, -1, 1, 3)


def to_long(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column_name, value) with null and NaN values and null keys left out."""
    values = [F.col(c).cast("double").alias(c) for c in columns]
    long = df.select(*keys, *values).unpivot(list(keys), list(columns), "column_name", "value")
    kept = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return kept.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])) if keys else kept


def _locate(value: Column, cuts: str, low: int, high: int) -> Column:
    """Interval number by binary search: odd on a cut point itself, even between cut points.

    A hot value next to a wanted rank thus stands alone. Nested branches keep the generated code
    short enough to be compiled.
    """
    if low == high:
        return F.lit(2 * low)
    middle = (low + high) // 2
    cut = F.get(cuts, F.lit(middle))
    return (
        F.when(value < cut, _locate(value, cuts, low, middle))
        .when(value == cut, F.lit(2 * middle + 1))
        .otherwise(_locate(value, cuts, middle + 1, high))
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """One row per (keys, column_name): ``n`` and ``q``, the interpolated quantiles in ``probs`` order.

    ``approx=True`` returns the sketch's own values after one pass.
    """
    group = [*keys, "column_name"]
    accuracy = accuracy or (2_000 if keys else 50_000)
    long = to_long(df, columns, keys)

    if approx:
        return long.groupBy(*group).agg(
            F.count("value").alias("n"), F.percentile_approx("value", list(probs), accuracy).alias("q")
        )

    ranks = sorted({min(1.0, max(0.0, p + k / accuracy)) for p in probs for k in CUT_OFFSETS})
    sketch = long.groupBy(*group).agg(
        F.count("value").alias("n"), F.percentile_approx("value", ranks, accuracy).alias("cuts")
    )
    # Materialised: the sketch depends on merge order, so every later pass must see the same cuts.
    # Without keys it is one row per column; with keys it is measured before it is broadcast.
    cuts = broadcast_if_small(sketch) if keys else F.broadcast(cut_lineage(sketch))
    interval = F.coalesce(_locate(F.col("value"), "cuts", 0, len(ranks)), F.lit(0))
    tagged = long.join(cuts, group).withColumn("interval", interval)

    by_interval = Window.partitionBy(*group).orderBy("interval")
    intervals = (
        tagged.groupBy(*group, "interval")
        .agg(F.count("value").alias("rows"), F.first("n").alias("n"))
        .withColumn("before", F.sum("rows").over(by_interval) - F.col("rows"))
    )
    position = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    wanted = reduce(
        Column.__or__,
        [
            (bound(h) >= F.col("before")) & (bound(h) < F.col("before") + F.col("rows"))
            for h in position
            for bound in (F.floor, F.ceil)
        ],
    )
    holding = intervals.where(wanted).select(*group, "interval", "before")
    # At most two rows per group and quantile.
    holding = broadcast_if_small(holding) if keys else F.broadcast(holding)

    by_value = Window.partitionBy(*group, "interval").orderBy("value")
    ranked = (
        tagged.join(holding, [*group, "interval"])
        .groupBy(*group, "interval", "before", "n", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("end", F.col("before") + F.sum("rows").over(by_value))
        .withColumn("start", F.col("end") - F.col("rows"))
    )

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("end")), F.col("value")))

    picked = ranked.groupBy(*group).agg(
        F.first("n").alias("n"),
        F.array(*[F.struct(at_rank(F.floor(h)).alias("lo"), at_rank(F.ceil(h)).alias("hi")) for h in position]).alias(
            "pair"
        ),
    )
    values = []
    for i, h in enumerate(position):
        pair = F.get("pair", F.lit(i))
        values.append(pair["lo"] + (pair["hi"] - pair["lo"]) * (h - F.floor(h)))
    return picked.select(*group, "n", F.array(*values).alias("q"))


def quantile_row(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **options) -> DataFrame:
    """One row: an array column ``<column>_q`` per input column. Columns without values give null."""
    long = exact_quantiles(df, columns, probs, **options)
    return long.agg(*[F.max(F.when(F.col("column_name") == c, F.col("q"))).alias(f"{c}_q") for c in columns])


def mode_row(df: DataFrame, column: str, name: str = "mode") -> DataFrame:
    """One row: the most frequent value, the smallest on ties; null for an empty column.

    Counts are combined per value before one top-1, so no task holds the whole value map.
    """
    top = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(1)
    )
    return top.agg(F.max(column).alias(name))
