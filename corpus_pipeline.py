"""Corpus preparation in five stages, each written as Parquet and read again as the next one's documents.

Every stage but the last returns rows of ``documents`` with all their columns. Defined cases of the operators hold: rows
without doc_id are told apart by text, repeated rows are one document in the duplicate stage, and null texts, which fail the
base rules, do not get past the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from folioforge.llm.decontam import decontaminate
from folioforge.llm.mixing import mix
from folioforge.llm.ngram_join import jaccard_join, node_id
from folioforge.llm.quality_rules import quality_rules
from folioforge.llm.queries import token_rows
from folioforge.session import broadcast_if_small, scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio against trusted documents keep."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    row = F.struct(*docs.columns).alias("__row")
    judged = quality_rules(docs.select("doc_id", "text", row), trusted)
    return judged.filter("kept").select("__row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of linked documents; documents without links stay."""
    docs = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")
    docs = docs.select("__row", node_id(F.col("doc_id"), F.col("text")).alias("__node"), F.xxhash64("text").alias("__text"))
    nodes = docs.select(F.col("__node").alias("doc_id"), F.col("__row.text").alias("text"))
    rows, _ = jaccard_join(nodes, real_ids=False)
    gone = rows.filter("doc_id <> component_id").select(F.col("doc_id").alias("__node")).distinct()
    kept = docs.join(broadcast_if_small(gone), "__node", "left_anti")
    # Equal texts under one id are one document; unlike texts under one id all stay. Only the rows whose key repeats are
    # brought together, and of those each task hands on one row per key; which one stays follows from its content.
    repeated = kept.groupBy("__node", "__text").count().filter("count > 1").select("__node", "__text")
    repeated = broadcast_if_small(repeated)
    same = Window.partitionBy("__node", "__text").orderBy(F.to_json("__row"))
    several = kept.join(repeated, ["__node", "__text"], "left_semi")
    one = several.withColumn("__n", F.row_number().over(same)).filter("__n = 1").drop("__n")
    return kept.join(repeated, ["__node", "__text"], "left_anti").unionByName(one).select("__row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_rows(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_quality),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

# The verdict of the first stage and the token ids have no SQL form; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
