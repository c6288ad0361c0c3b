"""Writers: CSV and Parquet outputs, zones, staged publishing, partition reloads, keyed upsert."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folioforge.operators.cdc import cdc_column_audit, upsert, with_keys
from folioforge.sources import files
from folioforge.sources.buckets import BUCKET, new_version, read_buckets, upsert_buckets

__all__ = ["BUCKET", "read_buckets", "upsert_buckets"]  # part of the sinks, in a module of their own

POINTER = "CURRENT"
KEEP_VERSIONS = 2


class RejectedPublish(RuntimeError):
    """Raised when staged rows do not pass validation; the target keeps its last version."""


def write_csv(df: DataFrame, path: str, drop: Sequence[str] = ()) -> None:
    df.drop(*drop).write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def as_money(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Money columns as DECIMAL(10,2), for sinks that declare them so; too large gives null."""
    return df.withColumns({c: F.col(c).try_cast("decimal(10,2)") for c in columns})


def write_zone(df: DataFrame, root: str, zone: str, run_id: str, source: str) -> str:
    """Write one run to the raw, staging or curated zone, with lineage columns; a re-run replaces it."""
    if zone not in ("raw", "staging", "curated"):
        raise ValueError(f"unknown zone {zone}")
    path = f"{root}/{zone}/run_id={run_id}"
    df.withColumn("_ingest_source", F.lit(source)).write.mode("overwrite").parquet(path)
    return path


def read_zone(spark: SparkSession, root: str, zone: str, run_id: str | None = None) -> DataFrame:
    """A zone's rows; columns that were added over time are merged and null in older runs."""
    df = spark.read.option("mergeSchema", True).parquet(f"{root}/{zone}")
    return df if run_id is None else df.where(F.col("run_id") == run_id)


def publish(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    validate: Callable[[DataFrame], bool] | None = None,
    keep: int = KEEP_VERSIONS,
) -> str:
    """Write a full new version beside the old one, validate it, then switch readers to it in one step.

    Any failure before the switch leaves the target as it was. After it the ``keep`` newest versions stay, at least the
    current one and the one before it, which readers may still be on.
    """
    version = new_version()
    path = f"{root}/versions/{version}"
    df.write.mode("errorifexists").parquet(path)
    if validate is not None and not validate(spark.read.parquet(path)):
        raise RejectedPublish(f"version {version} of {root} did not pass validation")
    files.replace_text(spark, f"{root}/{POINTER}", version)
    published = [v for v in files.list_names(spark, f"{root}/versions") if v <= version]
    for old in sorted(published)[: -max(2, keep)]:
        files.remove(spark, f"{root}/versions/{old}")
    return version


def read_published(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version; an empty frame of ``schema`` when nothing was published yet."""
    pointer = f"{root}/{POINTER}"
    if not files.exists(spark, pointer):
        if schema is None:
            raise FileNotFoundError(root)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{root}/versions/{files.read_text(spark, pointer).strip()}")


def publish_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    validate: Callable[[Mapping[str, DataFrame]], bool] | None = None,
    keep: int = KEEP_VERSIONS,
) -> str:
    """Publish several tables as one: readers see all of a run's tables or all of the run before.

    The pointer names one version of each table, so tables that are not part of this call keep theirs. ``validate`` sees
    the written tables before the switch. Versions that neither the new nor one of the ``keep - 1`` states before names go.
    """
    version = new_version()
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/tables/{name}/{version}")
    written = {name: spark.read.parquet(f"{root}/tables/{name}/{version}") for name in tables}
    if validate is not None and not validate(written):
        raise RejectedPublish(f"version {version} of {root} did not pass validation")
    states = _states(spark, root)
    current = {**(states[0] if states else {}), **dict.fromkeys(tables, version)}
    states = [current, *states][: max(2, keep)]
    files.replace_text(spark, f"{root}/{POINTER}", json.dumps(states))
    for name in tables:
        live = {state.get(name) for state in states}
        for old in files.list_names(spark, f"{root}/tables/{name}"):
            if old not in live and old < version:
                files.remove(spark, f"{root}/tables/{name}/{old}")
    return version


def _states(spark: SparkSession, root: str) -> list[dict[str, str]]:
    """Version of each table, newest state first."""
    pointer = f"{root}/{POINTER}"
    return json.loads(files.read_text(spark, pointer)) if files.exists(spark, pointer) else []


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of one state; the pointer is read once, so they belong together."""
    states = _states(spark, root)
    if not states:
        raise FileNotFoundError(root)
    return {name: spark.read.parquet(f"{root}/tables/{name}/{version}") for name, version in states[0].items()}


def full_load(spark: SparkSession, df: DataFrame, root: str, validate: Callable[[DataFrame], bool] | None = None) -> str:
    """Replace the whole target."""
    return publish(spark, df, root, validate)


def incremental_load(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    key: Sequence[str],
    order: Sequence[str | Column] = (),
    validate: Callable[[DataFrame], bool] | None = None,
) -> str:
    """Upsert by key into a published target; it rewrites the target, so one batch is one version."""
    return publish(spark, upsert(read_published(spark, root, df.schema), df, key, order), root, validate)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Reload only the partitions that are present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_change_audit(
    spark: SparkSession, current: DataFrame, batch: DataFrame, key: str, path: str, run_id: str, run_ts: str,
    ignore: Sequence[str] = (),
) -> None:
    """Record what an upsert of ``batch`` changes, column by column; run it before the upsert.

    A run has a partition of its own, so a repeated run replaces its records.
    """
    old = with_keys(current, batch, [key]).drop(*ignore)
    audit = cdc_column_audit(old, batch.drop(*ignore), [key]).select(
        F.col(key).cast("string").alias("key_id"),
        "action",
        "column_changed",
        "old_value",
        "new_value",
        F.lit(run_ts).cast("timestamp").alias("timestamp"),
    )
    write_parquet(audit, f"{path}/run_id={run_id}")


def report_json(report: DataFrame, run_ts: str) -> DataFrame:
    """One text row: overall result, time and the checks of a (short) report as JSON."""
    checks = F.collect_list(F.struct(*report.columns)).alias("checks")
    passed = F.coalesce(F.bool_and(F.col("status") != "FAIL"), F.lit(False)).alias("passed")
    return report.agg(passed, F.lit(run_ts).alias("timestamp"), checks).select(
        F.to_json(F.struct("passed", "timestamp", "checks")).alias("value")
    )


def write_report(report: DataFrame, path: str, run_ts: str) -> None:
    report_json(report, run_ts).write.mode("overwrite").text(path)
