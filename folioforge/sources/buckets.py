"""A table in key buckets whose upserts become visible in one step.

``data/version=V/bucket=B`` holds bucket B as batch V wrote it, and the note beside it names the version of every bucket,
the bucket count and the columns. An upsert writes the buckets it touches as a new version and then replaces the note by
one rename: readers see all of a batch or nothing, and a batch that failed between two buckets is simply repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folioforge.operators.cdc import one_per_key
from folioforge.sources import files

BUCKET = "bucket"
LAYOUT = "_layout"  # names with an underscore are no data to Spark
VERSION = "version"


class ConcurrentUpdate(RuntimeError):
    """The target or the batch changed while the batch was applied; nothing of it is visible."""


def new_version() -> str:
    """Names of versions sort by time."""
    return f"{datetime.now():%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def read_note(spark: SparkSession, path: str) -> tuple[dict, T.StructType] | None:
    """The note and the columns of a bucketed target."""
    name = f"{path}/{LAYOUT}"
    if not files.exists(spark, name):
        return None
    note = json.loads(files.read_text(spark, name))
    return note, T.StructType.fromJson(note["schema"])


def _data(spark: SparkSession, path: str, placed: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """The named buckets, each in its version; other folders are not even listed."""
    folders = [f"{path}/data/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(placed.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    names = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(names).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """A bucketed target with every column it ever got; files without one give null."""
    stored = read_note(spark, path)
    if stored is None:
        raise FileNotFoundError(f"{path} has no {LAYOUT}")
    return _data(spark, path, stored[0]["placed"], stored[1])


def upsert_buckets(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    key: Sequence[str],
    buckets: int = 64,
    order: Sequence[str | Column] = (),
    newest_wins: bool = False,
    slices: int = 4,
) -> None:
    """Upsert into a target laid out by key hash, rewriting only the buckets the batch touches, all of them or none.

    With ``newest_wins`` the row highest in ``order`` stays, so late rows do not undo newer ones;
    otherwise the batch wins. Repeating a batch gives the same target. The batch is reduced to one row
    per key first. ``buckets`` counts for a new target only: it is stored beside the data, with the columns, and later
    calls use the stored count, so a key never lies in two buckets. Columns that a batch adds are added to the target;
    columns that it lacks are null in its rows and stay in all others. A bucket is worked on by ``slices`` tasks.

    One writer at a time: a second one that switched meanwhile makes this one fail without effect. The versions of the
    state before the switch stay for readers that are still on it.
    """
    stored = read_note(spark, path)
    if stored is None and files.exists(spark, path):
        raise ValueError(f"{path} holds data without {LAYOUT}; load it into a new target")
    note = stored[0] if stored else {"buckets": buckets, "placed": {}}
    bucket = F.pmod(F.xxhash64(*key), F.lit(note["buckets"])).cast("int")
    batch = one_per_key(source, key, order).withColumns({BUCKET: bucket, "_side": F.lit(1)})
    merged, fields = batch, T.StructType([f for f in batch.schema.fields if f.name != "_side"])
    touched = None
    if stored is not None:
        known = set(stored[1].names)
        fields = T.StructType([*stored[1].fields, *[f for f in fields.fields if f.name not in known]])
        touched = {str(r[BUCKET]) for r in batch.select(BUCKET).distinct().collect()}  # as many as buckets at most
        old = _data(spark, path, {b: v for b, v in note["placed"].items() if b in touched}, stored[1])
        merged = old.withColumn("_side", F.lit(0)).unionByName(batch, allowMissingColumns=True)
    side = F.desc("_side")
    ranked = [F.desc(c) if isinstance(c, str) else c for c in order]
    rank = [*ranked, side] if newest_wins else [side, *ranked]
    part = F.pmod(F.xxhash64(F.lit("slice"), *key), F.lit(slices)).cast("int")
    # Clusters the window below as well: one shuffle, ``slices`` files per bucket.
    placed = merged.withColumn("_slice", part).repartition(BUCKET, "_slice")
    latest = one_per_key(placed, [BUCKET, "_slice", *key], rank).drop("_side", "_slice")
    version = new_version()
    folder = f"{path}/data/{VERSION}={version}"
    latest.write.partitionBy(BUCKET).parquet(folder)
    written = {n.partition("=")[2] for n in files.list_names(spark, folder) if n.startswith(f"{BUCKET}=")}
    if touched is not None and not written <= touched:
        raise ConcurrentUpdate(f"a batch for {path} gave other rows when it was read again")
    now = read_note(spark, path)
    if (now and now[0]) != (stored and stored[0]):
        raise ConcurrentUpdate(f"{path} was changed by another batch")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.fields])
    after = {**note["placed"], **dict.fromkeys(written, version)}
    switched = {"buckets": note["buckets"], "schema": nullable.jsonValue(), "placed": after, "before": note["placed"]}
    files.replace_text(spark, f"{path}/{LAYOUT}", json.dumps(switched))
    _clean(spark, path, version, [after, note["placed"]])


def _clean(spark: SparkSession, path: str, newest: str, states: Sequence[Mapping[str, str]]) -> None:
    """Remove the buckets that none of the states names, also those that failed batches left behind."""
    live = {(v, b) for placed in states for b, v in placed.items()}
    versions = {v for v, _ in live} | {newest}
    for name in files.list_names(spark, f"{path}/data"):
        version = name.partition("=")[2]
        if version not in versions and version < newest:
            files.remove(spark, f"{path}/data/{name}")
        elif version in versions:
            for child in files.list_names(spark, f"{path}/data/{name}"):
                if child.startswith(f"{BUCKET}=") and (version, child.partition("=")[2]) not in live:
                    files.remove(spark, f"{path}/data/{name}/{child}")
