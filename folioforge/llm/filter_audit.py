"""Filter interaction audit: what each filter removes in every order of application, from relations of failing ids.

1. One pass over the texts gives the facts of a row that filters A to D judge, and its print (md5 of the text). Rows of equal
   id and text become one row with their number, so that no key repeats.
2. One id table per filter is stored. E's is the anti join of the rows with (print, smallest id of that print): both sides
   are keyed by print and id, so a text with very many copies is no hot key.
3. The rows are split by one relation after the other, the rows in it by a left-semi and the others by a left-anti join. Each
   row ends in the class of relations that hold it; the labelled ids (good, toxic) are two relations more.
4. A prefix of filters keeps the classes that have no filter in common with it; survivors of all 32 prefixes are sums over
   the classes of a part, and every order and step is the difference of two prefixes.

Only ids, prints and parts are shuffled, never texts, and the joins do not grow with the number of orders.

Defined cases: null texts are empty, a null source is the empty part. A row without doc_id comes after all others: it repeats
if any row with an id holds its text. Rows that share a doc_id do not make each other repeat. A document is good (toxic) if
any of its label rows says so; rows without doc_id have no labels. An empty table has no parts and no rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from folioforge.llm.common import staged, words

KEYS = ["doc_id", "print"]
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SIGNS = 50, 65, 5, "[#$%&*|]"


def facts(docs: DataFrame) -> DataFrame:
    """One row per part, id and text: ``copies`` and the verdicts of filters A to D (true: fails)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    source = F.coalesce(F.col("source"), F.lit(""))
    rows = docs.select(source.alias("part"), "doc_id", text.alias("text"))
    rows = rows.select("*", words(F.col("text")).alias("words"))
    upper = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    judged = rows.select(
        "part",
        "doc_id",
        F.unhex(F.md5("text")).alias("print"),
        (F.size("words") < MIN_WORDS).alias("A"),
        (100 * F.size(F.array_distinct("words")) < MIN_DISTINCT * F.size("words")).alias("B"),
        (100 * upper > MAX_UPPER * F.length("text")).alias("C"),
        F.col("text").rlike(SIGNS).alias("D"),
    )
    return judged.groupBy(judged.columns).agg(F.count(F.lit(1)).alias("copies"))


def same_keys(left: DataFrame, right: DataFrame) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in right.columns])


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """The stored id table of each filter, in the order of their letters."""
    tables = {name: rows.filter(name).select(KEYS) for name in "ABCD"}
    firsts = rows.groupBy("print").agg(F.min("doc_id").alias("doc_id")).select(KEYS)
    ids = rows.select(KEYS)
    tables["E"] = ids.join(firsts, same_keys(ids, firsts), "left_anti")
    return {name: staged(table.distinct(), f"failing-{name}") for name, table in tables.items()}


def split(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``rows`` with column ``name``: whether the relation ``ids`` holds them."""
    held = rows.join(ids, same_keys(rows, ids), "left_semi").withColumn(name, F.lit(True))
    free = rows.join(ids, same_keys(rows, ids), "left_anti").withColumn(name, F.lit(False))
    return staged(held.union(free), f"split-{name}")


def classes(rows: DataFrame, failing: Mapping[str, DataFrame], labelled: Mapping[str, DataFrame]) -> DataFrame:
    """Per part and set of failed filters (``failed``, a bit per filter): documents and labelled documents."""
    rows = rows.select("part", *KEYS, "copies")
    for name, ids in {**failing, **labelled}.items():
        rows = split(rows, ids, f"in_{name}")
    bits = sum((F.when(F.col(f"in_{name}"), 1 << i).otherwise(0) for i, name in enumerate(failing)), F.lit(0))
    counts = [F.sum(F.when(F.col(f"in_{name}"), F.col("copies")).otherwise(0)).alias(name) for name in labelled]
    return rows.groupBy("part", bits.alias("failed")).agg(F.sum("copies").alias("n"), *counts)


def survivors(found: DataFrame, n_filters: int) -> DataFrame:
    """Documents that are left after each prefix (a set of filters, as bits); every prefix is there, with zeros."""
    counts = [c for c in found.columns if c not in ("part", "failed")]
    prefixes = F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))
    every = found.select("*", F.explode(prefixes).alias("prefix"))
    left = F.col("failed").bitwiseAND(F.col("prefix")) == 0
    return every.groupBy("part", "prefix").agg(*[F.sum(F.when(left, F.col(c)).otherwise(0)).alias(c) for c in counts])


def steps(names: str) -> Column:
    """All orders of the filters with their steps, as one constant array."""
    rows = []
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            name = "".join(names[j] for j in order)
            rows.append({"filter_order": name, "step": step, "filter": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    schema = "array<struct<filter_order:string,step:int,filter:int,before:int,after:int>>"
    return F.from_json(F.lit(json.dumps(rows)), schema)


def filter_audit(rows: DataFrame, failing: Mapping[str, DataFrame], labelled: Mapping[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step.

    ``rows`` has part, doc_id, print and copies; ``failing`` the id tables of filters named by one letter each; ``labelled``
    id tables of doc_id, whose losses come back as ``<name>_lost``.
    """
    names = "".join(failing)
    every, n = (1 << len(names)) - 1, len(names)
    left = survivors(classes(rows, failing, labelled), n)
    counts = ["n", *labelled]
    # A filter stands behind a given set of k others in k! (n - k - 1)! of the orders.
    orders = [math.factorial(k) * math.factorial(n - k - 1) for k in range(n)]
    share = []
    for i in range(n):
        signed = [-orders[p.bit_count() - 1] if p >> i & 1 else orders[p.bit_count()] for p in range(every + 1)]
        share.append(F.array(*map(F.lit, signed))[F.col("prefix")])
    by_part = left.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("prefix", F.struct(*counts)))).alias("left"),  # one entry per prefix
        F.array(*[F.sum(F.col("n") * w) for w in share]).alias("shapley"),
    )
    row = by_part.select("part", "left", "shapley", F.inline(steps(names)))
    of = lambda prefix, c: F.col("left")[prefix][c]
    before, after = F.col("before"), F.col("after")
    own = after.bitwiseXOR(before)
    removed = of(before, "n") - of(after, "n")
    return row.select(
        "part",
        "filter_order",
        "step",
        of(after, "n").alias("kept"),
        removed.alias("removed"),
        (of(F.lit(0), "n") - of(own, "n") - removed).alias("redundant"),
        (of(own.bitwiseXOR(F.lit(every)), "n") - of(F.lit(every), "n")).alias("unique_fails"),
        *[(of(before, c) - of(after, c)).alias(f"{c}_lost") for c in labelled],
        F.col("shapley")[F.col("filter")].alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, text, source), with the losses of good and toxic documents."""
    rows = staged(facts(docs), "facts")
    marked = {"good": labels.filter("quality = 1"), "toxic": labels.filter("toxic = 1")}
    marked = {name: ids.filter("doc_id IS NOT NULL").select("doc_id").distinct() for name, ids in marked.items()}
    return filter_audit(rows, failing_ids(rows), marked)
