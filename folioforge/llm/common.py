"""Column helpers and staging shared by the corpus operators.

Words are runs of characters other than the six ASCII white-space characters, in every operator.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import folioforge

from folioforge.session import scratch_path

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
BATCH_ROWS = 2000  # texts that a Python worker holds at once
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the built-in fast path."""
    ascii_only = F.octet_length(col) == F.char_length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def words(text: Column) -> Column:
    """Array of words; empty for null, empty and blank texts."""
    body = F.btrim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(F.length(body), F.lit(0)) > 0, F.split(body, SPACE_RUN)).otherwise(none)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it several times inside one expression."""
    return F.transform(F.array(value), body)[0]


def constant_doubles(values) -> Column:
    """A short list of numbers as one foldable array literal."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key's text form, modulo ``divisor``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % divisor


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns whose names the operator is about to add."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def fresh(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to a fresh Parquet folder below the shared folder and read it back: lineage ends, columns prune."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application; the driver serves the archive to them."""
    context = spark.sparkContext
    if getattr(context, "_folioforge_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(folioforge.__file__))
    archive = os.path.join(tempfile.mkdtemp(), "folioforge.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._folioforge_shipped = True


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with this package at hand in the tasks, and batches of at most BATCH_ROWS texts."""
    ship(df.sparkSession)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(limit)) <= BATCH_ROWS:
        df.sparkSession.conf.set(limit, BATCH_ROWS)
    return df.mapInArrow(work, schema)
