"""Slice, dice, rollup, drilldown and cube over a joined fact table, and read-only warehouse SQL."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioforge.functions.rounding import exact_mean, exact_sum, merged_parts, stable_round, sum_of_parts, sum_parts
from folioforge.session import cut_lineage


def star(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Inner star join; ``dims`` maps the fact's key column to (dimension, its key column).

    No broadcast hint: Spark broadcasts a dimension whose measured size is below its threshold.
    """
    for fact_key, (dim, dim_key) in dims.items():
        dim = dim.withColumnRenamed(dim_key, fact_key) if dim_key != fact_key else dim
        fact = fact.join(dim, fact_key)
    return fact


def measures(price: str, rating: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        stable_round(exact_mean(F.col(price)), 2).alias(f"avg_{price}"),
        stable_round(exact_mean(F.col(rating)), 2).alias(f"avg_{rating}"),
    ]


def slice_(df: DataFrame, fixed: Mapping[str, object], by: Sequence[str], price: str, rating: str) -> DataFrame:
    """One member of a dimension fixed, grouped by others."""
    for c, v in fixed.items():
        df = df.where(F.col(c) == v)
    return df.groupBy(*by).agg(*measures(price, rating)).orderBy(F.desc("row_count"), *by)


def dice(
    df: DataFrame,
    members: Mapping[str, Sequence[object]],
    ranges: Mapping[str, tuple[float, float]],
    by: Sequence[str],
    price: str,
    rating: str,
    top: int | None = None,
) -> DataFrame:
    """Several members and measure ranges, grouped by several dimensions; ordered, so a limit is exact."""
    for c, values in members.items():
        df = df.where(F.col(c).isin(list(values)))
    for c, (low, high) in ranges.items():
        df = df.where(F.col(c).between(low, high))
    out = df.groupBy(*by).agg(*measures(price, rating)).orderBy(*by)
    return out if top is None else out.limit(top)


def rollup_category(df: DataFrame, category: str, price: str, rating: str, flag: str, top: int | None = None) -> DataFrame:
    """Count, total, mean rating and flag sum per category, largest total first."""
    out = (
        df.groupBy(category)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            exact_sum(F.col(price)).alias("total_revenue"),
            stable_round(exact_mean(F.col(rating)), 2).alias(f"avg_{rating}"),
            F.sum(F.col(flag).cast("int")).alias("flagged"),
        )
        .orderBy(F.desc("total_revenue"), category)
    )
    return out if top is None else out.limit(top)


def drilldown(df: DataFrame, fixed: Mapping[str, object], columns: Sequence[str], order: Sequence[Column], top: int = 12):
    """Detail rows of one member, best first."""
    for c, v in fixed.items():
        df = df.where(F.col(c) == v)
    return df.orderBy(*order).select(*columns).limit(top)


def _cells(df: DataFrame, dims: Sequence[str], price: str, rating: str, *extra: Column) -> DataFrame:
    """Finest cells. Rollup and cube repeat these few rows per grouping set, not the fact rows."""
    return df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(price).alias("_np"),
        *sum_parts(F.col(price), "_sp"),
        F.count(rating).alias("_nr"),
        *sum_parts(F.col(rating), "_sr"),
        *extra,
    )


def _mean(total: str, n: str) -> Column:
    return stable_round(F.try_divide(sum_of_parts(total), F.sum(n)), 2)


def _merge(grouped, price: str, rating: str, *extra: Column) -> DataFrame:
    return grouped.agg(
        F.grouping_id().cast("bigint").alias("grouping_id"),
        F.sum("_n").alias("row_count"),
        sum_of_parts("_sp").alias(f"sum_{price}"),
        _mean("_sp", "_np").alias(f"avg_{price}"),
        _mean("_sr", "_nr").alias(f"avg_{rating}"),
        *extra,
    )


def rollup_total(df: DataFrame, dims: Sequence[str], price: str, rating: str) -> DataFrame:
    """Subtotals along ``dims`` and a grand total, told apart by ``grouping_id``."""
    return _merge(_cells(df, dims, price, rating).rollup(*dims), price, rating)


def cube_full(df: DataFrame, dims: Sequence[str], price: str, rating: str) -> DataFrame:
    """Every combination of ``dims``, told apart by ``grouping_id``."""
    return _merge(_cells(df, dims, price, rating).cube(*dims), price, rating)


def cube_state(df: DataFrame, dims: Sequence[str], price: str, rating: str, distinct: str | None = None) -> DataFrame:
    """The finest cells of a batch in a form that can be merged: counts, exact partial sums and a sketch of ``distinct``."""
    cells = _cells(df, dims, price, rating, *([F.hll_sketch_agg(distinct).alias("_d")] if distinct else []))
    return cells.withColumns({f"{s}_exact": F.col(f"{s}_exact").cast("decimal(38,12)") for s in ("_sp", "_sr")})


def merge_states(states: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Cells of several states as one state. A null member meets a null member."""
    sketch = [F.hll_union_agg("_d").alias("_d")] if "_d" in states.columns else []
    sums = [F.sum(c).alias(c) for c in ("_n", "_np", "_nr")]
    return states.groupBy(*dims).agg(*sums, *merged_parts("_sp"), *merged_parts("_sr"), *sketch)


def cube_of_state(state: DataFrame, dims: Sequence[str], price: str, rating: str) -> DataFrame:
    """What :func:`cube_full` gives over all facts of the state, with ``distinct_estimate`` if the state has sketches."""
    extra = [F.hll_sketch_estimate(F.hll_union_agg("_d")).alias("distinct_estimate")] if "_d" in state.columns else []
    return _merge(state.cube(*dims), price, rating, *extra)


def cube_slice(cube: DataFrame, dims: Sequence[str], wanted: Mapping[str, object]) -> DataFrame:
    """Cells of a stored cube where listed dimensions have a value and all others are rolled up (ALL)."""
    cells = cube.where(F.col("grouping_id") == _level(dims, wanted))
    for d, v in wanted.items():
        cells = cells.where(F.col(d) == v)
    return cells


def cube_cells(df: DataFrame, dims: Sequence[str], wanted: Mapping[str, object], price: str, rating: str) -> DataFrame:
    """The same cells from the fact: it is filtered first and grouped by the asked set only, without building the cube."""
    for d, v in wanted.items():
        df = df.where(F.col(d) == v)
    cells = _cells(df, list(wanted), price, rating).groupBy(*wanted).agg(
        F.sum("_n").alias("row_count"),
        sum_of_parts("_sp").alias(f"sum_{price}"),
        _mean("_sp", "_np").alias(f"avg_{price}"),
        _mean("_sr", "_nr").alias(f"avg_{rating}"),
    )
    shown = [F.col(d) if d in wanted else F.lit(None).cast("string").alias(d) for d in dims]
    level = F.lit(_level(dims, wanted)).cast("bigint").alias("grouping_id")
    return cells.select(*shown, level, *[c for c in cells.columns if c not in wanted])


def _level(dims: Sequence[str], wanted: Mapping[str, object]) -> int:
    return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in wanted)


def cube_topn(
    df: DataFrame, first: Sequence[str], second: Sequence[str], n_first: int, n_second: int, price: str, rating: str
) -> DataFrame:
    """Non-empty cells of the most frequent members of two axes; ties go by name."""

    # The fact is read once; both member lists and the result come from its finest cells.
    cells = cut_lineage(_cells(df, [*first, *second], price, rating))

    def top(axis: Sequence[str], n: int) -> DataFrame:
        members = cells.groupBy(*axis).agg(F.sum("_n").alias("_total")).orderBy(F.desc("_total"), *axis)
        return F.broadcast(members.limit(n).select(*axis))  # n is a fixed small number

    kept = cells.join(top(first, n_first), list(first), "left_semi").join(top(second, n_second), list(second), "left_semi")
    return kept.groupBy(*first, *second).agg(
        F.sum("_n").alias("row_count"), _mean("_sp", "_np").alias(f"avg_{price}"), _mean("_sr", "_nr").alias(f"avg_{rating}")
    )


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Publish warehouse tables as temporary views once; queries do not rebuild them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


# What is no code in a statement: raw strings, strings, quoted names and comments.
NO_CODE = re.compile(
    r"""\b[rR]'[^']*'|\b[rR]"[^"]*"|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\r\n]*|/\*.*?\*/""", re.DOTALL
)
READING = {"SELECT", "WITH", "VALUES", "TABLE", "FROM"}
CHANGING = {"INSERT", "UPDATE", "DELETE", "MERGE"}


def reads_only(sql: str) -> bool:
    """Whether a statement begins like a query and has no changing part behind a WITH or FROM.

    Where it is in doubt the statement is refused: a column named like one of CHANGING has to be quoted.
    """
    words = re.findall(r"\w+", NO_CODE.sub(" ", sql).upper())
    return bool(words) and words[0] in READING and not CHANGING & set(words)


def run_sql(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run one query over the registered views, with named parameters. The text runs as given; only queries are accepted."""
    if not reads_only(sql):
        raise ValueError("only SELECT queries are accepted")
    return spark.sql(sql, args=dict(args or {}))
