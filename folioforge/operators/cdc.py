"""Change data capture between two snapshots, change feeds, keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from folioforge.operators.dedup import keep_first


def one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the last in ``order``, then by all other columns.

    It hash-partitions by the key as the joins below do, so it adds a sort and no further shuffle,
    and it rules out row-pair explosions on a repeated key.
    """
    ranked = [F.desc(c) if isinstance(c, str) else c for c in order]
    rest = [F.desc(c) for c in sorted(df.columns) if c not in key]
    return keep_first(df, key, [*ranked, *rest] or key)


def compared_columns(old: DataFrame, new: DataFrame, key: Sequence[str]) -> list[str]:
    return [c for c in new.columns if c in old.columns and c not in key]


def as_text(df: DataFrame, column: str) -> Column:
    """Text form for audits: doubles with two digits where that is their exact value, else in full.

    Different values thus never share a text, and the audit shows every change the comparison sees.
    """
    kind = df.schema[column].dataType
    col = F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        money = col.try_cast("decimal(18,2)")
        return F.when(money.cast(kind) == col, money.cast("string")).otherwise(col.cast("string"))
    return col.cast("string")


def without_keys(rows: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key is not in ``other``; a missing key equals a missing key."""
    return _by_key(rows, other, key, "left_anti")


def with_keys(rows: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key is in ``other``; a missing key equals a missing key."""
    return _by_key(rows, other, key, "left_semi")


def _by_key(rows: DataFrame, other: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    marks = other.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)])
    return rows.join(marks, _met([(c, f"_k{i}") for i, c in enumerate(key)]), how)


def _met(pairs: Sequence[tuple[str, str]]) -> Column:
    met = F.lit(True)
    for a, b in pairs:
        met = met & F.col(a).eqNullSafe(F.col(b))
    return met


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str], missing_keys: bool = True) -> DataFrame:
    """(key, op, old, new): every key of both snapshots, with both rows as structs.

    ``op`` is INSERT, UPDATE, DELETE or UNCHANGED. Columns in both snapshots are compared, and null equals null; a
    missing key is a key like any other. Columns, or keys, of unlike types are compared by their audit text.

    Without ``missing_keys`` the caller promises that every row has its key: the join then is a plain equality, which tables
    bucketed by the key meet without a shuffle.
    """
    key = list(key)
    columns = compared_columns(old, new, key)
    unlike = [c for c in columns if old.schema[c].dataType != new.schema[c].dataType]
    for c in [c for c in key if old.schema[c].dataType != new.schema[c].dataType]:
        old, new = old.withColumn(c, as_text(old, c)), new.withColumn(c, as_text(new, c))

    def side(df: DataFrame, name: str) -> DataFrame:
        fields = [F.col(c) for c in df.columns if c not in key]
        fields += [as_text(df, c).alias(f"_text_{c}") for c in unlike]
        marks = [F.col(c).alias(f"_{name}{i}") for i, c in enumerate(key)]
        return one_per_key(df, key).select(*marks, F.struct(*fields, F.lit(1).alias("_in")).alias(name))

    pairs = [(f"_old{i}", f"_new{i}") for i in range(len(key))]
    met = _met(pairs) if missing_keys else reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in pairs])
    both = side(old, "old").join(side(new, "new"), met, "full_outer")
    same = F.lit(True)
    for c in [f"_text_{c}" if c in unlike else c for c in columns]:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    op = (
        F.when(F.col("old").isNull(), "INSERT")
        .when(F.col("new").isNull(), "DELETE")
        .when(same, "UNCHANGED")
        .otherwise("UPDATE")
    )
    keys = [F.coalesce(f"_old{i}", f"_new{i}").alias(c) for i, c in enumerate(key)]
    return both.select(*keys, op.alias("op"), "old", "new")


def cdc_summary(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: inserted, updated, deleted, unchanged."""
    return snapshot_diff(old, new, key).agg(
        F.count_if(F.col("op") == "INSERT").alias("inserted"),
        F.count_if(F.col("op") == "UPDATE").alias("updated"),
        F.count_if(F.col("op") == "DELETE").alias("deleted"),
        F.count_if(F.col("op") == "UNCHANGED").alias("unchanged"),
    )


def cdc_feed(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, op, new values): one event per changed key; a DELETE carries nulls."""
    values = [F.col(f"new.{c}").alias(c) for c in new.columns if c not in key]
    return snapshot_diff(old, new, key).where("op <> 'UNCHANGED'").select(*key, "op", *values)


def cdc_column_audit(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, action, column_changed, old_value, new_value): one row per changed column.

    An inserted or deleted row gives one row per column with a value.
    """
    columns = compared_columns(old, new, key)
    text_old = old.select(*key, *[as_text(old, c).alias(c) for c in columns])
    text_new = new.select(*key, *[as_text(new, c).alias(c) for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias("column_changed"), F.col(f"old.{c}").alias("old_value"), F.col(f"new.{c}").alias("new_value")
        )
        for c in columns
    ]
    changed = F.filter(F.array(*cells), lambda x: ~x["old_value"].eqNullSafe(x["new_value"]))
    return (
        snapshot_diff(text_old, text_new, key)
        .select(*key, F.col("op").alias("action"), F.explode(changed).alias("cell"))
        .select(*key, "action", "cell.*")
    )


def cdc_samples(old: DataFrame, new: DataFrame, key: Sequence[str], n: int = 5, placeholder: str = "N/A") -> DataFrame:
    """First ``n`` inserted and deleted rows by key, all columns as text, gaps as a placeholder."""

    def sample(rows: DataFrame, other: DataFrame, label: str) -> DataFrame:
        only = one_per_key(without_keys(rows, other, key), key)
        head = only.orderBy(*key).limit(n)
        shown = [F.coalesce(as_text(head, c), F.lit(placeholder)).alias(c) for c in rows.columns]
        return head.select(F.lit(label).alias("change"), *shown)

    return sample(new, old, "inserted").unionByName(sample(old, new, "deleted"))


def cdc_key_sets(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key_set, keys): sizes of new minus old, old minus new, and the intersection."""
    tagged = old.select(*key, F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(
        new.select(*key, F.lit(0).alias("o"), F.lit(1).alias("n"))
    )
    # One shuffle of distinct keys answers all three sets.
    per_key = tagged.groupBy(*key).agg(F.max("o").alias("o"), F.max("n").alias("n"))
    row = per_key.agg(
        F.count_if(F.col("o") == 0).alias("inserted"),
        F.count_if(F.col("n") == 0).alias("deleted"),
        F.count_if((F.col("o") == 1) & (F.col("n") == 1)).alias("common"),
    )
    return row.unpivot([], ["inserted", "deleted", "common"], "key_set", "keys")


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """Target with the source rows inserted or replacing whole rows.

    The row of a key that is last in ``order`` wins, among equals the one with the largest values; so without ``order``
    a repeated key is decided by value, not by arrival. A missing key is a key like any other.
    """
    latest = one_per_key(source, key, order)
    kept = without_keys(target, latest, key)
    return kept.unionByName(latest, allowMissingColumns=True)


def upsert_metrics(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: keys matched, inserted, modified, unchanged, and total_after, the rows that :func:`upsert` returns."""
    counts = snapshot_diff(target, source, key).agg(
        F.count_if(F.col("op").isin("UPDATE", "UNCHANGED")).alias("matched"),
        F.count_if(F.col("op") == "INSERT").alias("inserted"),
        F.count_if(F.col("op") == "UPDATE").alias("modified"),
        F.count_if(F.col("op") == "UNCHANGED").alias("unchanged"),
    )
    untouched = without_keys(target.select(*key), source, key).agg(F.count(F.lit(1)).alias("_kept"))
    total = F.col("_kept") + F.col("matched") + F.col("inserted")
    return counts.crossJoin(F.broadcast(untouched)).withColumn("total_after", total).drop("_kept")  # one row each


def apply_feed(
    target: DataFrame, feed: DataFrame, key: Sequence[str], order: Sequence[str | Column] = (), op: str = "op"
) -> DataFrame:
    """Target after a change feed: the last event of a key decides; DELETE removes it."""
    last = one_per_key(feed, key, order)
    kept = without_keys(target, last, key)
    return kept.unionByName(last.where(F.col(op) != "DELETE").select(*target.columns))
