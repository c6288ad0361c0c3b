"""Run log: one appended row per run, reports and metrics over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioforge.functions.rounding import stable_round
from folioforge.schemas import RUN_LOG


def append_run(spark: SparkSession, path: str, entry: Mapping[str, object], schema: T.StructType = RUN_LOG) -> None:
    """Append one run; unknown fields are refused, missing ones are null."""
    unknown = set(entry) - set(schema.names)
    if unknown:
        raise ValueError(f"unknown run log fields: {sorted(unknown)}")
    row = tuple(entry.get(name) for name in schema.names)
    spark.createDataFrame([row], schema).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str, schema: T.StructType = RUN_LOG) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def latest_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("run_timestamp"), F.desc("run_id")).limit(n)


def run_metrics(runs: DataFrame) -> DataFrame:
    """One row: runs, success and error rate (percent), mean latency, records per minute."""
    ok = F.count_if(F.col("status") == "SUCCESS")
    total = F.count(F.lit(1))
    minutes = F.sum("total_ms") / 60000.0
    return runs.agg(
        total.alias("runs"),
        stable_round(F.try_divide(ok * 100.0, total), 2).alias("success_rate"),
        stable_round(F.try_divide((total - ok) * 100.0, total), 2).alias("error_rate"),
        stable_round(F.avg("total_ms"), 1).alias("avg_latency_ms"),
        stable_round(F.try_divide(F.sum("records_loaded").cast("double"), minutes), 1).alias("records_per_minute"),
    )


def freshness(table: DataFrame, run_ts: str, loaded_at: str = "loaded_at") -> DataFrame:
    """One row: seconds between the run and the newest load."""
    newest = F.max(loaded_at).cast("timestamp")
    return table.agg(
        (F.unix_timestamp(F.lit(run_ts).cast("timestamp")) - F.unix_timestamp(newest)).alias("freshness_seconds")
    )
