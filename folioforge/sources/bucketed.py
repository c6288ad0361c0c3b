"""Tables laid out in hash buckets of their key, so that joins and windows on the key read them without a shuffle.

Both sides of a join need the same number of buckets. The layout is known to the session's catalog; data lie at ``path``.
Rows without a key have no bucket of their own: they are refused, as a plain equality join would lose them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_bucketed(df: DataFrame, name: str, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as table ``name`` in ``buckets`` buckets, one file each, sorted by the key; returns the table."""
    for c in key:
        message = F.lit(f"{name} needs a value of {c} in every row")
        df = df.withColumn(c, F.coalesce(F.col(c), F.raise_error(message).cast(df.schema[c].dataType)))
    # Dealt out as the buckets are, so that every bucket is one file.
    placed = df.repartition(buckets, *key)
    writer = placed.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
    return df.sparkSession.table(name)


def drop_bucketed(spark: SparkSession, *names: str) -> None:
    """Forget the tables; their data stay where they are."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
