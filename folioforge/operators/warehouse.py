"""Dimensional modelling: surrogate keys, dimensions, 3NF split, star and snowflake."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from folioforge.functions import text
from folioforge.operators.clean import PLACEHOLDER
from folioforge.session import broadcast_if_small, cut_lineage, literal_frame

UNKNOWN_KEY = -1
# monotonically_increasing_id: partition number above bit 33, position in the partition below.
POSITION_BITS = 33


def dense_keys(members: DataFrame, key: str, order: Sequence[str], start: DataFrame | None = None) -> DataFrame:
    """Number the rows 1, 2, 3 ... in a total order, without bringing them to one task.

    A range sort spreads the rows, each partition numbers its own, and the partition sizes (one row
    per partition) give the offsets. The sorted rows are checkpointed, as both uses must see the same
    partitions. ``start`` is a one-row frame with ``start``, the highest key already in use.
    """
    ordered = cut_lineage(members.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    ordered = ordered.withColumns(
        {
            "_part": F.shiftright("_pos", POSITION_BITS),
            "_row": F.col("_pos").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)),
        }
    )
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    numbered = ordered.join(F.broadcast(offsets), "_part")
    value = F.col("_offset") + F.col("_row") + 1
    if start is not None:
        numbered = numbered.crossJoin(F.broadcast(start))
        value = value + F.coalesce(F.col("start"), F.lit(0))
        numbered = numbered.withColumn(key, value).drop("start")
    else:
        numbered = numbered.withColumn(key, value)
    return numbered.select(key, *members.columns)


def dimension(
    df: DataFrame, column: str, key: str, name: str, exclude: Sequence[str] = (), first_seen: str | None = None
) -> DataFrame:
    """(key, name): the distinct values of a column, keyed from 1 by name, or by first appearance."""
    values = df.where(F.col(column).isNotNull())
    if exclude:
        values = values.where(~F.col(column).isin(list(exclude)))
    if first_seen is None:
        return dense_keys(values.select(F.col(column).alias(name)).distinct(), key, [name])
    seen = values.groupBy(F.col(column).alias(name)).agg(F.min(first_seen).alias("_seen"))
    return dense_keys(seen, key, ["_seen", name]).drop("_seen")


def with_unknown(dim: DataFrame, key: str) -> DataFrame:
    """The dimension with the member that rows without a match point at; its texts say so."""
    texts = {f.name: F.lit(PLACEHOLDER) for f in dim.schema.fields if f.dataType.simpleString() == "string"}
    member = dim.sparkSession.range(1).select(
        *[
            F.lit(UNKNOWN_KEY).cast(f.dataType).alias(f.name) if f.name == key else texts.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        ]
    )
    return dim.unionByName(member)


def dim_category(df: DataFrame, column: str = "category") -> DataFrame:
    """(category_key, category_name, parent_category)."""
    dim = dimension(df, column, "category_key", "category_name")
    return dim.withColumn("parent_category", text.parent_category(F.col("category_name")))


def dim_format(df: DataFrame, column: str = "format") -> DataFrame:
    return dimension(df, column, "format_key", "format_name")


def publisher_name(category: Column, suffix: str = "House") -> Column:
    return F.concat(category, F.lit(f" {suffix}"))


def dim_publisher(df: DataFrame, column: str = "category", region: str = "UK") -> DataFrame:
    """(publisher_key, publisher_name, region): names are derived from a column."""
    named = df.where(F.col(column).isNotNull()).select(publisher_name(F.col(column)).alias("publisher_name"))
    return dense_keys(named.distinct(), "publisher_key", ["publisher_name"]).withColumn("region", F.lit(region))


def dim_time(df: DataFrame, date_column: str) -> DataFrame:
    """(time_key, year, quarter, month): every month from the first to the last date."""
    span = df.agg(F.min(date_column).cast("date").alias("lo"), F.max(date_column).cast("date").alias("hi"))
    months = span.select(
        F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("interval 1 month"))).alias("m")
    )
    return months.select(
        time_key(F.col("m")).alias("time_key"),
        F.year("m").alias("year"),
        F.concat(F.lit("Q"), F.quarter("m").cast("string")).alias("quarter"),
        F.month("m").alias("month"),
    )


def month_dim(spark: SparkSession, first: str, months: int) -> DataFrame:
    """The same for a fixed number of months from a first day on."""
    start = F.lit(first).cast("date")
    return dim_time(spark.range(1).select(F.explode(F.array(start, F.add_months(start, months - 1))).alias("d")), "d")


def time_key(date: Column) -> Column:
    """Month number of a date; the fact computes it, so no time lookup join is needed."""
    return F.year(date) * 100 + F.month(date)


def spread_time_key(key: Column, first: str, months: int) -> Column:
    """A stable stand-in month for facts without a date, in the form of :func:`time_key`."""
    return time_key(F.add_months(F.lit(first).cast("date"), F.pmod(F.xxhash64(key), F.lit(months)).cast("int")))


def dim_upsert(existing: DataFrame, incoming: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name, is_new): old members keep their keys, new ones continue after the highest."""
    new = incoming.select(name).where(F.col(name).isNotNull()).distinct().join(existing.select(name), name, "left_anti")
    start = existing.agg(F.max(key).alias("start"))
    numbered = dense_keys(new, key, [name], start).withColumn("is_new", F.lit(True))
    return existing.select(key, name).withColumn("is_new", F.lit(False)).unionByName(numbered.select(key, name, "is_new"))


def lookup_key(
    df: DataFrame, dim: DataFrame, column: str, name: str, key: str, default: int = UNKNOWN_KEY
) -> DataFrame:
    """Replace a natural key by its surrogate; no match gives the unknown member.

    A dimension derived in the same job has no known size, so Spark would shuffle the fact for it. It is
    measured: broadcast when small, else joined without a hint, where Spark splits skewed keys.
    """
    members = broadcast_if_small(dim.select(F.col(name).alias("_member"), F.col(key).alias(key)))
    joined = df.join(members, F.col(column) == F.col("_member"), "left")
    return joined.withColumn(key, F.coalesce(key, F.lit(default).cast("bigint"))).drop("_member")


def books_3nf(df: DataFrame) -> dict[str, DataFrame]:
    """authors, publishers, categories and books with foreign keys, for all rows of a catalog."""
    authors = dimension(df, "author", "author_id", "author_name", exclude=[PLACEHOLDER])
    categories = dimension(df, "category", "category_id", "category_name")
    publishers = dimension(
        df.withColumn("publisher", publisher_name(F.col("category"), "Publishing")),
        "publisher",
        "publisher_id",
        "publisher_name",
    )
    books = df.dropna(subset=["isbn", "title"]).withColumn(
        "publisher_name", publisher_name(F.col("category"), "Publishing")
    )
    books = lookup_key(books, authors, "author", "author_name", "author_id")
    books = lookup_key(books, publishers.withColumnRenamed("publisher_name", "pn"), "publisher_name", "pn", "publisher_id")
    books = lookup_key(books, categories, "category", "category_name", "category_id")
    return {
        "authors": with_unknown(authors, "author_id"),
        "publishers": with_unknown(publishers, "publisher_id"),
        "categories": with_unknown(categories, "category_id"),
        "books": books.select(
            "isbn",
            F.substring("title", 1, 200).alias("title"),
            "author_id",
            "publisher_id",
            "category_id",
            "price",
            "rating",
        ),
    }


def star_schema(df: DataFrame, months: int = 6, first_month: str = "2024-01-01") -> dict[str, DataFrame]:
    """Category, format, publisher and time dimensions and the sales fact of a featured catalog.

    Every key of the fact has a member: rows without a match point at the unknown one. A catalog has no sales date, so rows
    are spread over ``months`` months by their identifier.
    """
    categories, formats, publishers = dim_category(df), dim_format(df), dim_publisher(df)
    rows = df.dropna(subset=["isbn", "category", "price"]).withColumn("_pub", publisher_name(F.col("category")))
    rows = lookup_key(rows, categories, "category", "category_name", "category_key")
    rows = lookup_key(rows, formats, "format", "format_name", "format_key")
    rows = lookup_key(rows, publishers, "_pub", "publisher_name", "publisher_key")
    fact = rows.select(
        F.md5("isbn").alias("sales_id"),  # 128 bits: unique without coordination
        "isbn",
        F.substring("title", 1, 150).alias("title"),
        "category_key",
        "publisher_key",
        "format_key",
        spread_time_key(F.col("isbn"), first_month, months).alias("time_key"),
        "price",
        "rating",
        F.col("discount_amount").alias("discount"),
        F.col("is_bestseller").cast("int").alias("is_bestseller"),
    )
    return {
        "dim_category": with_unknown(categories, "category_key"),
        "dim_format": with_unknown(formats, "format_key"),
        "dim_publisher": with_unknown(publishers, "publisher_key"),
        "dim_time": month_dim(df.sparkSession, first_month, months),
        "fact_book_sales": fact,
    }


def etl_fact(df: DataFrame) -> DataFrame:
    """The stored catalog fact: target columns in order, flag as 0/1."""
    columns = [
        "isbn", "title", "author", "format", "category", "price", "old_price", "rating",
        "discount_amount", "discount_pct", "price_gbp", "value_score", "is_bestseller", "price_tier",
    ]
    present = [c for c in columns if c in df.columns]
    return df.select(*[F.col(c).cast("int").alias(c) if c == "is_bestseller" else F.col(c) for c in present])


def fk_integrity(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(dimension, orphan_rows): fact rows without a member; ``dims`` maps a label to (dim, fact key, dim key).

    One pass over the fact: all its keys are unpivoted and counted per distinct value, with a map-side aggregate, and only
    distinct keys meet the dimensions. A null key is no orphan, as in a foreign key constraint.
    """
    labels = F.array(
        *[F.struct(F.lit(label).alias("dimension"), F.col(k).cast("string").alias("_key")) for label, (_, k, _) in dims.items()]
    )
    used = fact.select(F.inline(labels)).where("_key IS NOT NULL").groupBy("dimension", "_key").agg(F.count(F.lit(1)).alias("_n"))
    members = None
    for label, (dim, _, dim_key) in dims.items():
        part = dim.select(F.lit(label).alias("dimension"), F.col(dim_key).cast("string").alias("_key"))
        members = part if members is None else members.unionByName(part)
    orphans = used.join(members, ["dimension", "_key"], "left_anti").groupBy("dimension").agg(F.sum("_n").alias("orphan_rows"))
    wanted = literal_frame(fact.sparkSession, [(label,) for label in dims], "dimension string")
    return F.broadcast(wanted).join(orphans, "dimension", "left").select(
        "dimension", F.coalesce("orphan_rows", F.lit(0)).cast("bigint").alias("orphan_rows")
    )


def snowflake(dim: DataFrame, parent: str, key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Split a dimension in two: (dimension with the parent's key, parent dimension)."""
    parents = dimension(dim, parent, key, name)
    return lookup_key(dim, parents, parent, name, key).drop(parent), parents
