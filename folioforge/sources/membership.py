"""Content checksums of a target with an index of which file may hold which, so that a small batch opens few files.

A batch is written sorted by checksum over its files, so that each file covers a narrow range, and the range of every file is
stored beside the data. A later batch meets the ranges first and reads the checksum column of the files that may hold one of
its own. A note names the versions that count: data and index of a batch become visible together.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioforge.functions.checksum import row_sha256
from folioforge.session import broadcast_if_small, cut_lineage
from folioforge.sources import files
from folioforge.sources.buckets import ConcurrentUpdate, new_version

NOTE = "_versions"
HASH, KEY = "content_hash", "hash_key"
CELL_BITS = 12  # cells of the checksum space that ranges and checksums meet by
ROWS_PER_FILE = 1_000_000


def hash_key(content: Column) -> Column:
    """The leading 60 bits of a hexadecimal checksum as a number; ranges are kept of it."""
    return F.conv(F.substring(content, 1, 15), 16, 10).cast("bigint")


def _cell(key: Column) -> Column:
    return F.shiftright(key, 60 - CELL_BITS)


def versions(spark: SparkSession, path: str) -> list[str]:
    return json.loads(files.read_text(spark, f"{path}/{NOTE}")) if files.exists(spark, f"{path}/{NOTE}") else []


def read_indexed(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the target, without the checksum columns."""
    return spark.read.parquet(*[f"{path}/data/{v}" for v in versions(spark, path)]).drop(HASH, KEY)


def files_that_may_hold(spark: SparkSession, path: str, keys: DataFrame) -> list[str]:
    """Files whose range holds one of ``keys`` (a column KEY); as many names as the target has files at most."""
    live = versions(spark, path)
    if not live:
        return []
    ranges = spark.read.parquet(*[f"{path}/index/{v}" for v in live])
    cells = ranges.withColumn("cell", F.explode(F.sequence(_cell(F.col("low")), _cell(F.col("high")))))
    wanted = keys.select(KEY, _cell(F.col(KEY)).alias("cell"))
    met = broadcast_if_small(cells).join(wanted, "cell").where(F.col(KEY).between(F.col("low"), F.col("high")))
    return sorted(r["file"] for r in met.select("file").distinct().collect())


def new_rows(spark: SparkSession, source: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose content is not in the target yet, once each, with their checksum."""
    hashed = source.withColumn(HASH, row_sha256(columns)).dropDuplicates([HASH]).withColumn(KEY, hash_key(F.col(HASH)))
    hashed = cut_lineage(hashed)  # read three times, and every time the same rows
    held = files_that_may_hold(spark, path, hashed)
    if not held:
        return hashed
    return hashed.join(spark.read.parquet(*held).select(HASH), HASH, "left_anti")


def append_new(spark: SparkSession, source: DataFrame, path: str, columns: Sequence[str], n_files: int | None = None) -> int:
    """Append what is new and its ranges; returns the number of rows. Repeating a batch appends nothing."""
    live = versions(spark, path)
    fresh = cut_lineage(new_rows(spark, source, path, columns))
    rows = fresh.count()
    if not rows:
        return 0
    version = new_version()
    n_files = n_files or -(-rows // ROWS_PER_FILE)
    ordered = fresh.repartitionByRange(n_files, KEY).sortWithinPartitions(KEY)
    ordered.write.parquet(f"{path}/data/{version}")
    # One column of the rows just written; files are few against rows.
    written = spark.read.parquet(f"{path}/data/{version}").groupBy(F.input_file_name().alias("file"))
    written.agg(F.min(KEY).alias("low"), F.max(KEY).alias("high")).coalesce(1).write.parquet(f"{path}/index/{version}")
    if versions(spark, path) != live:
        raise ConcurrentUpdate(f"{path} was changed by another batch")
    files.replace_text(spark, f"{path}/{NOTE}", json.dumps([*live, version]))
    return rows
