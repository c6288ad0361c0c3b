"""Parquet tables and the messy inputs that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Portable text: the same rows in Spark and in an ANSI engine. ``{part}`` is the part table.
CATALOG_SQL = """
SELECT p_partkey AS ingest_seq,
  CASE WHEN p_partkey % 41 = 0 THEN NULL
       WHEN p_partkey % 29 = 0 THEN concat('X', CAST(p_partkey AS STRING))
       ELSE CAST(9780000000000 + CASE WHEN p_partkey % 10 = 1 THEN p_partkey - 1 ELSE p_partkey END AS STRING) END AS isbn,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE concat('  ', p_name, ' ') END AS name,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END AS author,
  CASE p_partkey % 4 WHEN 0 THEN 'Paperback' WHEN 1 THEN 'Hardback' WHEN 2 THEN 'Audio CD' ELSE NULL END AS format,
  p_type AS category,
  CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN 'N/A'
       ELSE concat('$', CAST(p_size AS STRING), '.49') END AS price,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat(CAST(p_size + p_partkey % 20 AS STRING), '.99') END AS old_price,
  CASE WHEN p_partkey % 19 = 0 THEN NULL
       ELSE concat(CAST(p_partkey % 5 AS STRING), CASE WHEN p_partkey % 2 = 0 THEN '.5' ELSE '.0' END) END AS book_depository_stars,
  concat('dataset/', p_type, '/', CAST(p_partkey AS STRING), '.jpg') AS img_paths
FROM {part}
"""

# Flat record fields with gaps, repeated keys, repeated identifiers and outliers.
RECORD_SQL = """
SELECT p_partkey AS ingest_seq,
  concat('/works/', CAST(CASE WHEN p_partkey % 10 = 3 THEN p_partkey - 1 ELSE p_partkey END AS STRING)) AS key,
  CASE WHEN p_partkey % 43 = 0 THEN NULL ELSE p_name END AS title,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS author,
  CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat(p_type, ' Press') END AS publisher,
  CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 8 = 1 THEN concat('X', CAST(p_partkey AS STRING))
       ELSE CAST(9780000000000 + CASE WHEN p_partkey % 14 = 5 THEN p_partkey - 1 ELSE p_partkey END AS STRING) END AS isbn,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS subject,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 1900 + p_partkey % 125 END AS first_publish_year,
  CASE WHEN p_partkey % 12 = 0 THEN NULL WHEN p_partkey % 97 = 0 THEN 5000 ELSE p_size * 13 + p_partkey % 7 END AS number_of_pages_median,
  CASE WHEN p_partkey % 15 = 0 THEN NULL ELSE CAST(p_partkey % 41 AS DOUBLE) / 8 END AS ratings_average,
  CASE WHEN p_partkey % 18 = 0 THEN NULL ELSE p_partkey % 300 END AS ratings_count,
  CASE p_partkey % 3 WHEN 0 THEN 'science' WHEN 1 THEN 'technology' ELSE 'medicine' END AS _source
FROM {part}
"""
RECORD_SOURCES = ["science", "technology", "medicine"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dirty catalog: every cleaning rule has something to do."""
    return spark.sql(CATALOG_SQL, part=table(spark, sf_dir, "part"))


def records_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents: list columns with a further item, empty lists and nulls."""
    flat = spark.sql(RECORD_SQL, part=table(spark, sf_dir, "part"))
    lists = {
        c: F.when(F.col(c).isNotNull(), F.array(F.col(c), F.lit("second")))
        for c in ("author", "publisher", "isbn", "subject")
    }
    lists["isbn"] = F.coalesce(lists["isbn"], F.array().cast("array<string>"))
    return flat.withColumns(lists).withColumnRenamed("author", "author_name")


def sales(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    """Line items joined with the asked dimensions, ``part`` and ``supplier`` (with its region); with both by default."""
    # One dimension at a time: Spark sizes a table from its files but not a join of tables, so joining
    # the dimensions among themselves first would make it shuffle the fact.
    fact, dims = table(spark, sf_dir, "lineitem"), dims or ("part", "supplier")
    if "part" in dims:
        fact = fact.join(table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
    if "supplier" in dims:
        fact = (
            fact.join(table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .drop("s_acctbal", "s_nationkey", "n_nationkey", "n_name", "n_regionkey", "r_regionkey")
        )
    return fact


def order_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of a rolling order book: all orders up to 2000, then all from July 1995 on.

    Between them old orders are dropped, new ones arrive, and pending orders are charged a fee.
    """
    orders = table(spark, sf_dir, "orders")
    old = orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    new = orders.where(F.col("o_orderdate") >= F.lit("1995-07-01").cast("timestamp_ntz")).withColumn(
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", F.round(F.col("o_totalprice") + 1, 2)).otherwise(F.col("o_totalprice")),
    )
    return old, new
