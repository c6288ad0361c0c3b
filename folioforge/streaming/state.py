"""Keyed state kept inside a stream: the last row of every key, with expiry, and the log of its changes."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioforge.operators.cdc import one_per_key
from folioforge.streaming.jobs import write_batches


def last_rows(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    time: str = "ts",
    delay: str = "1 day",
    idle: str = "30 days",
) -> DataFrame:
    """Every change of a key's last row in ``order``, in update mode: key, order and ``columns``.

    One row per key is held in the state store, so a row that arrives late does not undo a newer one, whatever
    micro-batches they come in. A key without rows for ``idle`` of event time leaves the store; rows behind the watermark
    are dropped, so it cannot come back with an older one. Missing values in ``order`` come before all others.
    """
    shown = list(dict.fromkeys([*key, *order, *columns]))
    schema = T.StructType([df.schema[c] for c in shown])
    kept_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def rank(row: tuple) -> tuple:
        values = [row[shown.index(c)] for c in order]
        return tuple((not pd.isna(v), None if pd.isna(v) else v) for v in values)

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = best = pickle.loads(state.get[0]) if state.exists else None
        for frame in frames:
            for row in frame[shown].itertuples(index=False, name=None):
                if best is None or rank(row) > rank(best):
                    best = row
        state.update((pickle.dumps(best),))
        seen = pd.Timestamp(best[shown.index(time)]) if time in shown else None
        base = int(seen.timestamp() * 1000) if seen is not None and not pd.isna(seen) else 0
        state.setTimeoutTimestamp(max(base, state.getCurrentWatermarkMs() + 1) + kept_ms)
        if best != before:
            yield pd.DataFrame([best], columns=shown)

    grouped = df.withWatermark(time, delay).groupBy(*key)
    return grouped.applyInPandasWithState(step, schema, "last binary", "update", GroupStateTimeout.EventTimeTimeout)


def write_changes(changes: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append the changes of each micro-batch; nothing that was written before is read or rewritten."""
    return write_batches(changes, path, checkpoint, mode="update")


def read_last(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of every key from the log of changes."""
    return one_per_key(spark.read.parquet(path).drop("batch_id"), key, order)


def compact(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str | Column], target: str) -> None:
    """Write one row per key of the log to ``target``, for readers that should not rank it."""
    read_last(spark, path, key, order).withColumn("batch_id", F.lit(-1)).write.mode("overwrite").partitionBy("batch_id").parquet(target)
