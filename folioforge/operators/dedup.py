"""Duplicate removal and duplicate counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioforge.functions.checksum import row_sha256
from folioforge.functions.text import trimmed


def keep_first(df: DataFrame, key: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key in the given (total) order.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle, so a hot key
    reaches its reducer as one row per map task.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedup_by_key(df: DataFrame, key: str, order: Sequence[str | Column], keep_blank: bool = False) -> DataFrame:
    """Keep-first by one text key. Null and blank keys count as one key, or are all kept."""
    filled = df.withColumn(key, F.coalesce(trimmed(F.col(key).cast("string")), F.lit("")))
    if not keep_blank:
        return keep_first(filled, [key], order)
    blank = F.col(key) == ""
    return filled.where(blank).unionByName(keep_first(filled.where(~blank), [key], order))


def dedup_two_stage(
    df: DataFrame, first_key: Sequence[str], second_key: Sequence[str | Column], blank: Column, order: Sequence[str]
) -> DataFrame:
    """Keep-first by ``first_key``, then by ``second_key`` among rows that are not ``blank``."""
    once = keep_first(df, first_key, order)
    # One window for both kinds of row: a blank row is alone in its group through its first key.
    own = F.when(blank, F.struct(*first_key))
    return keep_first(once, [own, *[F.when(~blank, F.col(c) if isinstance(c, str) else c) for c in second_key]], order)


def duplicate_counts(df: DataFrame, keys: dict[str, Sequence[str]]) -> DataFrame:
    """(scope, duplicate_rows): rows beyond the first of each key; nulls are equal to each other."""
    parts = []
    for scope, columns in keys.items():
        groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")).select(
                F.lit(scope).alias("scope"), "duplicate_rows"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def new_by_checksum(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the source whose content hash is not in the target yet."""
    known = target.select(row_sha256(columns).alias("_hash"))
    return source.withColumn("_hash", row_sha256(columns)).join(known, "_hash", "left_anti").drop("_hash")
