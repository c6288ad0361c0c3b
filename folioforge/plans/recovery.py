"""Recovery jobs: checksums, missing partitions, backfill, bounded retry."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import date, timedelta
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioforge.functions.checksum import row_sha256
from folioforge.sources import files
from folioforge.sources.sinks import overwrite_partitions

R = TypeVar("R")


class Throttled(RuntimeError):
    """The source asked for a pause or is down (HTTP 429, 503); trying again at once does not help."""


# Three retries, two seconds before the first.
MAX_RETRIES = 3
RETRY_DELAY = 2.0


def retry(
    step: Callable[[], R],
    retries: int = MAX_RETRIES,
    delay: float = RETRY_DELAY,
    factor: float = 2.0,
    max_delay: float = 60.0,
    fatal: tuple[type[BaseException], ...] = (Throttled,),
    sleep: Callable[[float], None] = time.sleep,
) -> R:
    """Run a job step, again after a growing pause when it fails; ``factor=1`` keeps the pause fixed."""
    for attempt in range(retries + 1):
        try:
            return step()
        except fatal:
            raise
        except Exception:
            if attempt == retries:
                raise
            sleep(min(max_delay, delay * factor**attempt))
    raise AssertionError("unreachable")


def dataset_checksum(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(rows, checksum): the same for any row order and partitioning.

    Sum of the leading 48 bits of every row's SHA-256, combined in the map tasks.
    """
    leading = F.conv(F.substring(row_sha256(columns), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(leading), F.lit(0)).cast("decimal(38,0)").cast("string").alias("checksum"),
    )


def missing_partitions(df: DataFrame, day: Column, start: str | None = None, end: str | None = None) -> DataFrame:
    """(missing_date): the days of a range without rows; the range defaults to the data's own."""
    days = df.select(day.cast("date").alias("d")).where(F.col("d").isNotNull()).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    span = days.agg(
        F.coalesce(F.lit(start).cast("date"), F.min("d")).alias("lo"),
        F.coalesce(F.lit(end).cast("date"), F.max("d")).alias("hi"),
    ).where(F.col("lo") <= F.col("hi"))
    wanted = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("missing_date"))
    return wanted.join(days, wanted.missing_date == days.d, "left_anti")


def backfill(
    source: DataFrame, target: DataFrame, path: str, day: str, process: Callable[[DataFrame], DataFrame],
    start: str, end: str,
) -> None:
    """Process only the missing days of a target that is partitioned by ``day``, and add them.

    Existing partitions are neither read in full nor rewritten, and a repeated run finds nothing to do.
    """
    gaps = missing_partitions(target, F.col(day), start, end)
    # One row per day of the asked range: bounded, and it prunes the source's partitions.
    todo = source.join(F.broadcast(gaps), F.col(day).cast("date") == F.col("missing_date"), "left_semi")
    overwrite_partitions(process(todo), path, [day])


def present_days(spark: SparkSession, path: str, day: str) -> set[str]:
    """Days that a target partitioned by ``day`` has, from the names of its folders; no file is opened."""
    if not files.exists(spark, path):
        return set()
    return {n.partition("=")[2] for n in files.list_names(spark, path) if n.startswith(f"{day}=")}


def backfill_partitions(
    spark: SparkSession, source: DataFrame, path: str, day: str, process: Callable[[DataFrame], DataFrame], start: str, end: str
) -> list[str]:
    """Add the days of a range that the target lacks; returns them.

    The days are known before the plan is made and stand in it as constants, so of a source that is partitioned by ``day``
    only their folders are listed and read. The target is not read. Days without source rows stay missing.
    """
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    wanted = [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    present = present_days(spark, path, day)
    missing = [d for d in wanted if d not in present]
    if missing:
        todo = source.where(F.col(day).isin([date.fromisoformat(d) for d in missing]))
        overwrite_partitions(process(todo), path, [day])
    return missing
