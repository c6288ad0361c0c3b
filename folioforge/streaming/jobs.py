"""Ingest, dedup, windowed counts and keyed state over a stream of messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from folioforge.sources.sinks import overwrite_partitions, upsert_buckets


def read_messages(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    latest_first: bool = False,
    files_per_batch: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Files that arrive in a folder, with a declared schema. ``latest_first`` starts with the newest."""
    reader = spark.readStream.format(fmt).schema(schema).option("latestFirst", latest_first)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def parse(df: DataFrame, column: str, schema: T.StructType | str, name: str = "message") -> DataFrame:
    """Parse a JSON text column; unparseable text gives null in ``name``."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    fields = T.StructType.fromDDL(ddl) if isinstance(schema, str) else schema
    declared = T.StructType([*fields.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(F.col(column), declared, {"columnNameOfCorruptRecord": "_bad"})
    return df.withColumn("_parsed", parsed).withColumn(
        name, F.when(F.col("_parsed").isNotNull() & F.col("_parsed._bad").isNull(), F.col("_parsed").dropFields("_bad"))
    ).drop("_parsed")


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a zoned timestamp; the session runs in UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def write_append(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append rows to Parquet, each exactly once, and stop when all available input is done."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def write_batches(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", after: Callable[[int], None] | None = None
) -> DataStreamWriter:
    """Write every micro-batch to a partition of its own. A batch that failed is run again under its old number and
    replaces what it left, so each row is there once. ``after`` is called when a batch is written; if it fails, so does the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        overwrite_partitions(batch.withColumn("batch_id", F.lit(batch_id)), path, ["batch_id"])
        if after is not None:
            after(batch_id)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(availableNow=True)


def drain(writer: DataStreamWriter) -> None:
    """Run a stream over all available input and wait for it."""
    query = writer.start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def dedup(df: DataFrame, key: Sequence[str], time: str = "ts", delay: str = "1 day") -> DataFrame:
    """Drop replays of a key that arrive within ``delay``; state older than that is dropped."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def throughput(
    df: DataFrame,
    by: Sequence[str] = (),
    time: str = "ts",
    size: str = "1 minute",
    slide: str | None = None,
    delay: str = "10 minutes",
    session_gap: str | None = None,
) -> DataFrame:
    """(window_start, by..., n): tumbling, sliding, or sessions of a gap.

    Appended, a window appears once it is closed by the watermark; :func:`upsert_windows` also stores the open ones.
    """
    if session_gap:
        window = F.session_window(time, session_gap)
    else:
        window = F.window(time, size, slide) if slide else F.window(time, size)
    counted = df.withWatermark(time, delay).groupBy(window.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), *by, "n")


def upsert_windows(
    counted: DataFrame, target: str, checkpoint: str, by: Sequence[str] = (), buckets: int = 64
) -> DataStreamWriter:
    """Keep the latest count of every window that :func:`throughput` gives, open ones included, so that no event is left
    out when the input ends. Not for session windows, which Spark cannot update."""
    return upsert_stream(counted, target, checkpoint, ["window_start", *by], ["n"], buckets=buckets, mode="update")


def operations(df: DataFrame, op: str, wanted: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Change events of the wanted operation types, projected; no state."""
    return df.where(F.col(op).isin(list(wanted))).select(op, *columns)


def upsert_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    key: Sequence[str],
    order: Sequence[str | Column] = (),
    good: Column | None = None,
    dead_letters: str | None = None,
    buckets: int = 64,
    newest_wins: bool = True,
    mode: str = "append",
) -> DataStreamWriter:
    """Upsert every micro-batch into a bucketed target; rows that are not ``good`` go to dead letters.

    A batch that is run again after a failure changes nothing: the upsert is repeatable, and the dead
    letters of a batch have a partition of their own, which is overwritten.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if good is None:
            upsert_buckets(spark, batch, target, key, buckets, order, newest_wins)
            return
        accepted = F.coalesce(good, F.lit(False))
        batch = batch.persist()  # two sinks read it
        try:
            if dead_letters is not None:
                bad = batch.where(~accepted).withColumn("batch_id", F.lit(batch_id))
                overwrite_partitions(bad, dead_letters, ["batch_id"])
            upsert_buckets(spark, batch.where(accepted), target, key, buckets, order, newest_wins)
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(apply).trigger(availableNow=True)
