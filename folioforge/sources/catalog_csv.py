"""Catalog CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioforge.schemas import RAW_CATALOG

CORRUPT = "_corrupt_record"


class EmptySource(ValueError):
    """Raised for a source without rows."""


def read_catalog_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = RAW_CATALOG,
    sequence: bool = True,
    multi_line: bool = False,
    require_rows: bool = True,
) -> DataFrame:
    """Read headered CSV. Rows that do not fit the schema keep their text in ``_corrupt_record``.

    Columns go by header name, in any order; those the schema does not list are read as text. A file
    whose header differs from the first one is refused. Bytes that are no valid UTF-8 become replacement
    characters. Without a ``schema`` every column is text. Nothing is inferred, so the data is read once.
    ``ingest_seq`` orders rows by (file, split, row), which is what keep-first rules need.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("enforceSchema", False)
    if schema is not None:
        header = reader.csv(path).columns  # reads one line
        types = {f.name: f.dataType for f in schema.fields}
        fields = [T.StructField(c, types.get(c, T.StringType())) for c in header]
        declared = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(declared).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.csv(path)
    if sequence:
        df = df.withColumn(
            "ingest_seq",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("split"),
                F.monotonically_increasing_id().alias("row"),
            ),
        )
    if require_rows and df.isEmpty():
        raise EmptySource(f"no rows in {path}")
    return df


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, corrupt rows) of a staged read; stage (write or checkpoint) the read first."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())
