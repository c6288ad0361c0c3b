"""Registered corpus queries over the whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioforge.llm import byte_bpe, language, rule_quality, toxicity
from folioforge.llm.common import remainder, staged
from folioforge.llm.decontam import leaks
from folioforge.llm.filter_audit import audit_documents
from folioforge.llm.line_dedup import dedup_lines
from folioforge.llm.mixing import copies, mix_plan, sized
from folioforge.llm.ngram_join import jaccard_join
from folioforge.llm.quality_rules import quality_rules
from folioforge.llm.token_counts import token_counts
from folioforge.llm.token_files import read_tokens, token_folder, write_tokens
from folioforge.llm.vector_codes import vector_codes

from folioforge.session import broadcast_if_small

END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


@query
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = staged(sized(table(spark, sf_dir, "documents", "doc_id", "text", "source")), "sizes")
    taken = copies(sizes, mix_plan(sizes))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def token_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs`` and read them back."""
    folder = token_folder(spark)
    return read_tokens(write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"), END_ID), folder)


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "united").distinct()


def held_out(fold: int, folds: int):
    return F.coalesce(remainder("doc_id", folds) == fold, F.lit(False))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.fit(docs.filter(remainder("doc_id", 3) != 1))
    return language.predict(docs.select("doc_id", "text", held_out(1, 3).alias("held_out")), model)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learned = docs.filter(remainder("doc_id", 3) != 1)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").filter(remainder("doc_id", 3) != 1).filter("toxic IS NOT NULL")
    labelled = learned.select("doc_id", "text").join(broadcast_if_small(labels), "doc_id")
    network = toxicity.fit(labelled, language.fit(learned))
    return toxicity.score(docs.select("doc_id", "text", held_out(1, 3).alias("held_out")), network)


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    judged = quality_rules(table(spark, sf_dir, "documents", "doc_id", "text"), trusted)
    return judged.drop("text")


@query
def op9_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    featured = staged(rule_quality.with_features(docs).select("doc_id", "features"), "features")
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    model = rule_quality.fit(featured, labels)
    scored = featured.select("doc_id", held_out(0, 5).alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(table(spark, sf_dir, "documents", "doc_id", "text", "source"), table(spark, sf_dir, "labels"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = staged(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN), "ids")
    listed = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    digests = coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"))
    decoded = byte_bpe.decode(digests, ranks)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
