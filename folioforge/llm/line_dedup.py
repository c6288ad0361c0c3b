"""Corpus-wide line dedup: lines found in many documents stay in one of them only.

Lines are exploded with their position, normalised and hashed to 128 bits; documents are counted per hash; lines over the
threshold go, except in the largest document id that holds them; texts are put together again by position.

Shuffles: one of (hash, count, largest id), one of (hash, document, position), one of the texts. A hash held by a third of
all documents is pre-aggregated in the map tasks; its join with the repeated hashes is one that Spark splits when skewed.

Defined cases: a null or empty text is one empty line. Rows that share a doc_id count as one document, and each row keeps
its own text. Rows without doc_id count as one document each and come before every id; if only such rows hold a line, all
keep it. Equal rows give equal results. Other columns pass through, except those named like a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioforge.llm.common import SPACES, ascii_lower, staged, without


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def ids_repeat(docs: DataFrame) -> bool:
    """Whether any doc_id occurs in several rows; then documents, not rows, have to be counted."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").groupBy("doc_id").count()
    return not ids.filter("count > 1").isEmpty()


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Every row with ``text`` after the drop (never null), ``n_lines`` before it and ``n_dropped``."""
    docs = without(docs, "n_lines", "n_dropped")
    rest = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"), F.struct(*[F.col(c) for c in rest], F.lit(0).alias("__")).alias("__rest"))
    lines = (
        docs.select("doc_id", F.xxhash64(text).alias("__row"), F.posexplode(F.split(text, "\n", -1)).alias("__pos", "__line"))
        .select("doc_id", "__row", "__pos", line_key(F.col("__line")).alias("__key"))
        .filter(F.char_length("__key") >= min_chars)
        .select("doc_id", "__row", "__pos", F.xxhash64("__key").alias("__k1"), F.xxhash64(F.lit("line"), "__key").alias("__k2"))
    )
    # Once per document and line: the same line within a document is one holder.
    held = (
        docs.select("doc_id", F.explode(F.array_distinct(F.transform(F.split(text, "\n", -1), line_key))).alias("__key"))
        .filter(F.char_length("__key") >= min_chars)
        .select("doc_id", F.xxhash64("__key").alias("__k1"), F.xxhash64(F.lit("line"), "__key").alias("__k2"))
    )
    holders = F.count(F.lit(1))
    if ids_repeat(docs):
        holders = F.count_distinct("doc_id") + F.sum(F.isnull("doc_id").cast("long"))
    repeated = (
        held.groupBy("__k1", "__k2")
        .agg(holders.alias("__docs"), F.max("doc_id").alias("__keeper"))
        .filter(F.col("__docs") >= min_docs)
        .drop("__docs")
    )
    # Written first, so that both sides of the join are dealt for it alone and Spark can split a hot hash.
    repeated = staged(repeated, "repeated-lines")
    drops = (
        lines.join(repeated, ["__k1", "__k2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("__keeper")))
        .groupBy(F.col("doc_id").alias("__id"), "__row")
        .agg(F.collect_set("__pos").alias("__drop"))
    )
    split = F.split("text", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.coalesce("__drop", F.array().cast("array<int>")))
    put = F.array_join(F.transform(F.col("__keep"), lambda p: F.col("__lines")[p]), "\n")
    joined = (
        base.withColumn("__row", F.xxhash64("text"))
        .withColumnRenamed("__row", "__row0")
        .join(drops, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row0") == F.col("__row")), "left")
        .withColumn("__lines", split)
        .withColumn("__keep", places)
    )
    return joined.select(
        "doc_id",
        F.when(F.isnull("__drop"), F.col("text")).otherwise(put).alias("text"),
        *[F.col("__rest")[c].alias(c) for c in rest],
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__keep")).cast("long").alias("n_dropped"),
    )
