"""Quality rules: hashed n-gram log-likelihood ratio between trusted texts and the raw corpus.

Two multinomials over hashed word and punctuation unigrams and bigrams: one of all documents, and one of the trusted
documents, smoothed towards the first.
A document's score is its log-likelihood ratio divided by its number of n-grams, and the same fixed threshold decides every
document. Base rules on words, symbols, lines and repeated word windows come before it. Everything is a column expression:
one counting pass over the corpus, whose result has a fixed number of cells, and a scoring pass without a shuffle.

Defined cases: a null text has no words and all its counts are 0; it fails the base rules. Rows are judged one by one, so
equal rows get equal results. A null doc_id is never trusted. With no trusted document at all the ratio says nothing: every
score is 0 and only the base rules decide. Other columns pass through, except those named like a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from folioforge.llm.common import SPACE_RUN, constant_doubles, fresh, let, without, words
from folioforge.session import broadcast_if_small

CELLS = 1 << 14  # per n-gram order
THRESHOLD = -0.5  # nats per n-gram
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def pieces(text: Column) -> Column:
    """Lower-cased runs of letters and digits, and runs of other visible characters."""
    pattern = "[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+"
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def repeated_words(tokens: Column) -> Column:
    """Words inside a three-word window that occurs twice or more in the text."""
    last = F.size(tokens) - 3
    hashed = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(tokens[i], tokens[i + 1], tokens[i + 2]))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def spots(s: Column) -> Column:
            same = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            return F.flatten(F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))

        count = F.size(F.array_distinct(let(placed, spots)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(count)

    return F.when(last < 1, F.lit(0)).otherwise(let(hashed, covered))


def with_base_rules(docs: DataFrame) -> DataFrame:
    """Add the base counts and ``base_failed``."""
    docs = without(docs, *RESULTS)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    counts = let(words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r")))
    held = fresh(docs, "__counts")
    return (
        docs.withColumn(held, counts)
        .withColumn("n_words", F.col(held)["n"].cast("long"))
        .withColumn("word_chars", F.char_length(F.regexp_replace(text, SPACE_RUN, "")).cast("long"))
        .withColumn("n_symbols", F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"))
        .withColumn("n_dup_lines", let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", F.col(held)["r"].cast("long"))
        .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
        .drop(held)
    )


def ngram_weights(docs: DataFrame, trusted: DataFrame, cells: int = CELLS) -> list[float]:
    """Log ratio of each cell: unigram cells, then bigram cells. ``trusted`` (doc_id) names the target documents."""
    ids = broadcast_if_small(trusted.select("doc_id").filter("doc_id IS NOT NULL").distinct().withColumn("__target", F.lit(1)))
    marked = docs.select("doc_id", "text").join(ids, "doc_id", "left")
    grams = (
        marked.select(F.coalesce("__target", F.lit(0)).alias("t"), pieces(F.col("text")).alias("p"))
        .filter(F.size("p") > 0)
        .select("t", "p", F.explode(F.sequence(F.lit(0), F.size("p") - 1)).alias("i"))
        .select("t", F.get("p", F.col("i")).alias("x"), F.get("p", F.col("i") + 1).alias("y"))
    )
    one = F.pmod(F.xxhash64("x"), F.lit(cells))
    two = F.when(F.isnotnull("y"), F.pmod(F.xxhash64("x", "y"), F.lit(cells)) + cells)
    counted = (
        grams.select("t", F.explode(F.array(one, two)).alias("cell"))
        .filter("cell IS NOT NULL")
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("target"))
    )
    raw, target = [0] * (2 * cells), [0] * (2 * cells)
    for cell, n, hits in counted.collect():  # 2 * cells rows at most
        raw[cell], target[cell] = n, hits
    if not sum(target):
        return [0.0] * (2 * cells)
    out: list[float] = []
    for part in (slice(0, cells), slice(cells, 2 * cells)):
        # One pseudo-count per cell at the raw rate: cells that little is known of stay near 0.
        share = sum(target[part]) / max(1, sum(raw[part]))
        out += [math.log((h + 1) / (r * share + 1)) for r, h in zip(raw[part], target[part])]
    return out


def likelihood_ratio(text: Column, weights: list[float]) -> Column:
    """Sum of the cells' weights over the text's n-grams, divided by their number; 0 without n-grams."""
    cells = len(weights) // 2
    table = constant_doubles(weights)

    def total(p: Column) -> Column:
        one = lambda i: table[F.pmod(F.xxhash64(p[i]), F.lit(cells)).cast("int")]
        two = lambda i: table[F.pmod(F.xxhash64(p[i], F.get(p, i + 1)), F.lit(cells)).cast("int") + cells]
        last = F.size(p) - 1
        summed = F.aggregate(
            F.sequence(F.lit(0), last), F.lit(0.0), lambda s, i: s + one(i) + F.when(i < last, two(i)).otherwise(0.0)
        )
        return F.when(last < 0, F.lit(0.0)).otherwise(summed / (2 * last + 1))

    return let(pieces(text), total)


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, cells: int = CELLS) -> DataFrame:
    """Every row with the base counts, ``base_failed``, ``llr`` and ``kept``."""
    weights = ngram_weights(docs, trusted, cells)
    scored = with_base_rules(docs).withColumn("llr", likelihood_ratio(F.col("text"), weights))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
