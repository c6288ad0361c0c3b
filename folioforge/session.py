"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# SQL settings that change results (time zone) or that let Spark re-plan at run time.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Settings that only a new session can take.
START_SETTINGS = {
    # Plans are built from many small column calls; recording a call site for each is most of their cost.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Files of reliable checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "folioforge", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or get) a session. On a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings to a session that someone else started."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary folder.
    """
    setting = spark.conf.get("spark.checkpoint.dir", None)
    if setting:
        return setting
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), f"folioforge-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows as a plan Spark knows the size of, so it can decide how to join them."""
    fields = [field.split() for field in schema.split(",")]
    structs = [
        F.struct(*[F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


# Largest side that is broadcast after it was measured: rows, and bytes as Spark's own row width.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Materialise a derived side, measure it, and broadcast it only below a fixed bound.

    Spark cannot size an aggregate beforehand, so it would shuffle the large side as well. Beyond the
    bound the side is returned without a hint: Spark shuffles, and splits skewed keys at run time.
    """
    staged = cut_lineage(df)
    text = [f.name for f in staged.schema.fields if f.dataType.simpleString() == "string"]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(16 * len(staged.columns)))
    arrays = [f.name for f in staged.schema.fields if f.dataType.simpleString().startswith("array")]
    width = sum((F.coalesce(F.size(c), F.lit(0)) * 16 for c in arrays), width)
    size = staged.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    small = size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES
    return F.broadcast(staged) if small else staged


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written once and every later use reads the same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
