"""Column profiles: nulls, moments, quantiles, histograms, correlation, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from folioforge.functions.rounding import stable_round
from folioforge.operators.wide_profile import approx_profile, wide_profile
from folioforge.session import literal_frame

# Profile quantiles and the interquartile fence.
PROFILE_PROBS = (0.25, 0.5, 0.75, 0.9)
QUARTILES = (0.25, 0.75)
IQR_FACTOR = 1.5


def stack(row: DataFrame, label: str, parts: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row frame into one row per label without another aggregate."""
    rows = [
        F.struct(F.lit(name).alias(label), *[c.alias(field) for field, c in fields.items()])
        for name, fields in parts.items()
    ]
    return row.select(F.inline(F.array(*rows)))


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_types(df: DataFrame) -> list[tuple[str, str, str]]:
    """(column, type, kind) from the schema alone."""
    numeric = set(numeric_columns(df))
    return [
        (f.name, f.dataType.simpleString(), "numeric" if f.name in numeric else "categorical") for f in df.schema.fields
    ]


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, missing, missing_pct), every column counted in one pass."""
    columns = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)]
    )
    return stack(
        row,
        "column_name",
        {
            c: {
                "missing": F.col(f"_n{i}"),
                "missing_pct": stable_round(F.coalesce(F.try_divide(F.col(f"_n{i}") * 100.0, F.col("_rows")), F.lit(0.0)), 2),
            }
            for i, c in enumerate(columns)
        },
    )


def null_totals(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells and their share."""
    missing = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    row = df.agg(F.count(F.lit(1)).alias("total_rows"), F.coalesce(F.sum(missing), F.lit(0)).alias("total_missing"))
    cells = F.greatest(F.col("total_rows") * len(df.columns), F.lit(1))
    return row.select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_cols"),
        "total_missing",
        stable_round(F.col("total_missing") * 100.0 / cells, 2).alias("missing_pct"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str], digits: int = 3, approx: bool = False) -> DataFrame:
    """Count, mean, deviation, bias-corrected shape, extremes and exact quantiles per column that has values.

    Two scans give all columns; shape is 0 for two values or fewer. ``approx`` takes the sketch's quantiles after one scan.
    """
    if approx:
        profiles = approx_profile(df, columns, PROFILE_PROBS)
    else:
        profiles = wide_profile(df, columns, PROFILE_PROBS, moments=True)
    names = ("n", "mean", "std", "g1", "g2", "min", "max", "q25", "median", "q75", "q90")
    rows = [
        (c, p.n, *[p.moments[k] for k in ("mean", "std", "g1", "g2", "min", "max")], *p.quantiles)
        for c, p in profiles.items()
        if p.n
    ]
    schema = "column_name string, n bigint, " + ", ".join(f"{name} double" for name in names[1:])
    found = literal_frame(df.sparkSession, rows, schema) if rows else df.sparkSession.createDataFrame([], schema)
    n = F.col("n").cast("double")
    skew = F.try_divide(F.sqrt(n * (n - 1)), n - 2) * F.col("g1")
    kurt = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    measures = {
        "mean": F.col("mean"),
        "median": F.col("median"),
        "std": F.col("std"),
        "skew": F.when(n <= 2, F.lit(0.0)).otherwise(skew),
        "kurt": F.when(n <= 2, F.lit(0.0)).otherwise(kurt),
        "min": F.col("min"),
        "max": F.col("max"),
        "q25": F.col("q25"),
        "q75": F.col("q75"),
        "q90": F.col("q90"),
        "iqr": F.col("q75") - F.col("q25"),
    }
    return found.select("column_name", "n", *[stable_round(c, digits).alias(k) for k, c in measures.items()])


def summary_points(profile: DataFrame) -> DataFrame:
    """Seven-point summary: a slice of :func:`numeric_profile`."""
    return profile.select("column_name", "min", "q25", "median", "mean", "q75", "q90", "max")


def describe_exact(profile: DataFrame) -> DataFrame:
    """``describe`` table with exact quartiles: a slice of :func:`numeric_profile`."""
    return profile.select("column_name", "n", "mean", "std", "min", "q25", "median", "q75", "max")


def histogram(df: DataFrame, column: str | Column, bins: int = 20) -> DataFrame:
    """(bin, centre, count) over equal bins from minimum to maximum; the last bin is closed.

    Empty bins are kept. A constant column is widened by half a unit on both sides.
    """
    values = df.select((F.col(column) if isinstance(column, str) else column).cast("double").alias("x"))
    values = values.where(F.col("x").isNotNull() & ~F.isnan("x"))
    span = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = span.where(F.col("lo").isNotNull()).select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = (
        values.crossJoin(F.broadcast(span)).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    )
    grid = span.select("lo", width.alias("width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(F.broadcast(counts), "bin", "left").select(  # at most ``bins`` rows
        "bin",
        stable_round(F.col("lo") + (F.col("bin") + 0.5) * F.col("width"), 2).alias("centre"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("count"),
    )


def histogram_log(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Histogram of log10 of the positive values."""
    return histogram(df.where(F.col(column) > 0), F.log10(F.col(column)), bins)


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """(col_a, col_b, r) as a full square; pairwise complete; null for a constant column."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    typed = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])

    def pearson(a: str, b: str) -> Column:
        # Spark's own corr divides by zero, and so fails in ANSI mode, on a constant column.
        spread = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b)))
        return F.try_divide(F.covar_pop(a, b), spread)

    row = typed.agg(*[pearson(a, b).alias(f"{a}~{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        raw = F.col(f"`{a}~{b}`")
        r = F.when(raw.isNotNull(), F.lit(1.0) if a == b else stable_round(raw, digits))
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), r.alias("r")))
    return row.select(F.inline(F.array(*cells)))


def iqr_bounds(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with ``<column>_lo`` and ``<column>_hi`` fences, null for a column without values."""
    find = approx_profile if approx else wide_profile
    fences = []
    for c, p in find(df, columns, QUARTILES, fence_factor=IQR_FACTOR).items():
        for side, value in zip(("lo", "hi"), p.fences or (None, None)):
            fences.append(F.lit(value).cast("double").alias(f"{c}_{side}"))
    return df.sparkSession.range(1).select(*fences)


def outside(column: str) -> Column:
    return (F.col(column) < F.col(f"{column}_lo")) | (F.col(column) > F.col(f"{column}_hi"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """(column_name, outliers, pct, severity) of all columns from two scans."""
    if approx:
        fenced = df.select(*columns).crossJoin(F.broadcast(iqr_bounds(df, columns, approx)))
        row = fenced.agg(
            *[F.count_if(outside(c)).alias(f"_o{i}") for i, c in enumerate(columns)],
            *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)],
        )
    else:
        found = wide_profile(df, columns, QUARTILES, fence_factor=IQR_FACTOR)
        counts = [(f"_o{i}", found[c].outliers) for i, c in enumerate(columns)] + [(f"_n{i}", found[c].n) for i, c in enumerate(columns)]
        row = df.sparkSession.range(1).select(*[F.lit(v).cast("bigint").alias(name) for name, v in counts])
    parts = {}
    for i, c in enumerate(columns):
        pct = stable_round(F.col(f"_o{i}") * 100.0 / F.greatest(F.col(f"_n{i}"), F.lit(1)), 2)
        severity = F.when(pct < 5, "Normal").when(pct < 15, "Moderate").otherwise("High")
        parts[c] = {"outliers": F.col(f"_o{i}"), "pct": pct, "severity": severity}
    return stack(row, "column_name", parts)


def iqr_cap(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clip the columns to their fences; the fences stay as ``<column>_lo`` and ``<column>_hi``."""
    fenced = df.crossJoin(F.broadcast(iqr_bounds(df, columns)))
    return fenced.withColumns(
        {
            c: F.when(F.col(c) < F.col(f"{c}_lo"), F.col(f"{c}_lo"))
            .when(F.col(c) > F.col(f"{c}_hi"), F.col(f"{c}_hi"))
            .otherwise(F.col(c))
            for c in columns
        }
    )


def iqr_cap_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, lower, upper, capped, capped_sum) of :func:`iqr_cap`, without writing or passing over the capped rows."""
    found = wide_profile(df, columns, QUARTILES, fence_factor=IQR_FACTOR, sums=True)
    rows = [(c, *(p.fences or (None, None)), p.outliers, p.capped_sum) for c, p in found.items()]
    row = literal_frame(df.sparkSession, rows, "column_name string, lower double, upper double, capped bigint, capped_sum double")
    return row.select(
        "column_name",
        stable_round(F.col("lower"), 4).alias("lower"),
        stable_round(F.col("upper"), 4).alias("upper"),
        "capped",
        F.round("capped_sum", 2).alias("capped_sum"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """(column_name, distinct_values) without nulls; ``approx=True`` is one pass without a shuffle of values."""
    if approx:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"_d{i}") for i, c in enumerate(columns)])
        return stack(row, "column_name", {c: {"distinct_values": F.col(f"_d{i}")} for i, c in enumerate(columns)})
    typed = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = typed.unpivot([], list(columns), "column_name", "value").where(F.col("value").isNotNull())
    return long.distinct().groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def value_counts(df: DataFrame, columns: Sequence[str], top: int = 15) -> DataFrame:
    """(column_name, value, rows, distinct_values): the most frequent values, ties by value.

    The counts are combined per value first; the rank runs over counts, with a group limit.
    """
    typed = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        typed.unpivot([], list(columns), "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    order = Window.partitionBy("column_name").orderBy(F.desc("rows"), "value")
    best = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top).drop("_rank")
    # Counts the same column as the ranking reads, so Spark reuses the shuffled counts.
    distinct = counts.groupBy("column_name").agg(F.count("rows").alias("distinct_values"))
    return best.join(F.broadcast(distinct), "column_name")  # one row per profiled column


def missing_cells(columns: Sequence[str]) -> Column:
    """Number of null cells of a row."""
    return sum((F.col(c).isNull().cast("bigint") for c in columns), F.lit(0).cast("bigint"))


def stage_metrics(
    rows: DataFrame,
    keys: Mapping[str, Column],
    order: Column,
    all_rows: Mapping[str, Column],
    kept: Mapping[str, Column],
) -> DataFrame:
    """Metrics of all stages of a run from one pass over rows that carry what each stage made of them.

    ``keys`` go from the finest to the coarsest, and each follows from the one before: the first row in ``order`` per
    coarsest key is the one that deduplication keeps. One row comes back: ``rows``, the number of values of each key under
    its name, the sums of ``all_rows`` over all rows and of ``kept`` over the kept ones. Rows are combined per key before
    the shuffle, so a key that many rows share is one row per task, and repeated tasks do not count twice, as the
    counters of ``observe`` may.
    """
    names = list(keys)
    marked = rows.select(
        *[c.alias(f"_k{i}") for i, c in enumerate(keys.values())],
        F.lit(1).cast("bigint").alias("rows"),
        *[c.cast("bigint").alias(name) for name, c in all_rows.items()],
        order.alias("_order"),
        F.struct(F.lit(1).alias("_"), *[c.cast("bigint").alias(name) for name, c in kept.items()]).alias("_kept"),
    )
    summed = ["rows", *all_rows]
    for i in range(len(names)):
        counted = summed + names[: max(0, i)]
        marked = marked.groupBy(*[f"_k{j}" for j in range(i, len(names))]).agg(
            *[F.sum(c).alias(c) for c in counted],
            F.min_by("_kept", "_order").alias("_kept"),
            F.min("_order").alias("_order"),
        ).withColumn(names[i], F.lit(1).cast("bigint"))
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*summed, *names)]
    return marked.agg(*totals, *[F.coalesce(F.sum(f"_kept.{c}"), F.lit(0)).alias(c) for c in kept])


def before_after(metrics: DataFrame, raw_columns: int, columns: int, watched: Sequence[str]) -> DataFrame:
    """(attribute, before, after): rows, columns, null cells, null share, duplicate keys, watched nulls.

    ``metrics`` is a row of :func:`stage_metrics` with keys raw_keys and kept_rows, raw_nulls and raw_<column> of all rows, and
    nulls and <column> of the kept ones.
    """

    def side(total: Column, cols: int, nulls: str, duplicates: Column, prefix: str) -> dict[str, Column]:
        cells = F.greatest(total * cols, F.lit(1))
        return {
            "rows": total,
            "columns": F.lit(cols),
            "null_cells": F.col(nulls),
            "null_pct": stable_round(F.col(nulls) * 100.0 / cells, 2),
            "duplicate_keys": duplicates,
            **{f"nulls_{c}": F.col(f"{prefix}{c}") for c in watched},
        }

    before = side(F.col("rows"), raw_columns, "raw_nulls", F.col("rows") - F.col("raw_keys"), "raw_")
    after = side(F.col("kept_rows"), columns, "nulls", F.lit(0), "")
    parts = {k: {"before": before[k].cast("double"), "after": after[k].cast("double")} for k in before}
    return stack(metrics, "attribute", parts)


def transform_summary(metrics: DataFrame) -> DataFrame:
    """One row: rows in and out, duplicates removed, null cells filled, flagged rows; from :func:`stage_metrics`."""
    return metrics.select(
        F.col("rows").alias("input_rows"),
        F.col("kept_rows").alias("output_rows"),
        (F.col("rows") - F.col("kept_rows")).alias("dupes_removed"),
        (F.col("gaps") - F.col("gaps_left")).alias("nulls_filled"),
        "flagged",
    )


def stage_funnel(metrics: DataFrame, stages: Mapping[str, tuple[str, int]]) -> DataFrame:
    """(stage, rows, cols); each stage names its count in :func:`stage_metrics` and its number of columns."""
    return stack(metrics, "stage", {s: {"rows": F.col(c), "cols": F.lit(n)} for s, (c, n) in stages.items()})


def extract_summary(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(measure, value): rows, columns, null cells, nulls of the listed columns and duplicate keys, from one pass."""
    gaps = {f"nulls_{c}": F.col(c).isNull() for c in columns}
    metrics = stage_metrics(df, {"_keys": F.col(key)}, F.lit(0), {"null_cells": missing_cells(df.columns), **gaps}, {})
    values = {
        "rows": F.col("rows"),
        "columns": F.lit(len(df.columns)).cast("bigint"),
        "null_cells": F.col("null_cells"),
        "duplicate_keys": F.col("rows") - F.col("_keys"),
        **{name: F.col(name) for name in gaps},
    }
    return stack(metrics, "measure", {k: {"value": v} for k, v in values.items()})
