"""Grouped statistics of the catalog and of nested-source records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from folioforge.functions.rounding import exact_mean, stable_round
from folioforge.operators.clean import PLACEHOLDER
from folioforge.operators.quantiles import exact_quantiles
from folioforge.session import broadcast_if_small


def category_stats(df: DataFrame) -> DataFrame:
    """Books, mean price, rating and discount, and bestsellers per category; largest first."""
    return (
        df.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.count("isbn").alias("total_books"),
            stable_round(exact_mean(F.col("price")), 2).alias("avg_price_usd"),
            stable_round(exact_mean(F.col("rating")), 2).alias("avg_rating"),
            stable_round(exact_mean(F.col("discount_pct")), 1).alias("avg_discount"),
            F.count_if("is_bestseller").alias("bestsellers"),
        )
        .orderBy(F.desc("total_books"), "category")
    )


def top_entities(df: DataFrame, entity: str = "author", n: int = 10) -> DataFrame:
    """The entities with most rows; the placeholder is left out, ties go by name."""
    return (
        df.where(F.col(entity) != PLACEHOLDER)
        .groupBy(entity)
        .agg(
            F.count("isbn").alias("books"),
            stable_round(exact_mean(F.col("rating")), 2).alias("avg_rating"),
            stable_round(exact_mean(F.col("price")), 2).alias("avg_price"),
        )
        .orderBy(F.desc("books"), entity)
        .limit(n)
    )


def category_insights(df: DataFrame, n: int = 8) -> DataFrame:
    """(insight, category, value): top categories by mean discount and by bestsellers.

    Both rankings come from one aggregate; the rank runs over categories, with a group limit.
    """
    per_category = (
        df.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            exact_mean(F.col("discount_pct")).alias("top_discounted"),
            F.count_if("is_bestseller").cast("double").alias("top_bestsellers"),
        )
    )

    both = per_category.unpivot(["category"], ["top_discounted", "top_bestsellers"], "insight", "value")
    order = Window.partitionBy("insight").orderBy(F.desc("value"), "category")
    best = both.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    return best.select("insight", "category", stable_round(F.col("value"), 1).alias("value"))


def tier_counts(df: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """(tier_column, tier, rows) for several tier columns in one shuffle."""
    return (
        df.select(*tiers)
        .unpivot([], list(tiers), "tier_column", "tier")
        .where(F.col("tier").isNotNull())
        .groupBy("tier_column", "tier")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def source_summary(df: DataFrame) -> DataFrame:
    """Per source: rows, mean rating (2 digits), mean pages (whole), flag sums; largest first."""
    return (
        df.groupBy("api_source")
        .agg(
            F.count(F.lit(1)).alias("total_books"),
            stable_round(F.avg("avg_rating"), 2).alias("avg_rating"),
            stable_round(F.avg("pages"), 0).alias("avg_pages"),
            F.sum("is_highly_rated").alias("highly_rated_count"),
            F.sum("has_isbn").alias("books_with_isbn"),
        )
        .orderBy(F.desc("total_books"), "api_source")
    )


def quality_counts(df: DataFrame) -> DataFrame:
    """One row with five conditional counts, one pass."""
    return df.agg(
        F.count_if(F.col("has_isbn") == 1).alias("with_isbn"),
        F.count_if(F.col("has_isbn") == 0).alias("without_isbn"),
        F.count_if(F.col("is_highly_rated") == 1).alias("highly_rated"),
        F.count_if(F.col("avg_rating") == 0).alias("zero_rating"),
        F.count_if(F.col("publisher") != "Unknown Publisher").alias("with_publisher"),
    )


def popularity_topk(df: DataFrame, k: int = 5) -> DataFrame:
    """The records with the highest score; ties go by key."""
    best = df.orderBy(F.desc("popularity_score"), "ol_key").limit(k)
    return best.select("ol_key", "title", "author", "avg_rating", "rating_count", "popularity_score")


def entity_relative(
    df: DataFrame, entity: str, measure: str, group: str | None = None, group_measure: str | None = None
) -> DataFrame:
    """Attach to every row its entity's row count and mean, and the distance from a group's median.

    Aggregates are joined back instead of windowed: a window would bring a hot entity's rows to one
    task. An aggregate that measures small is broadcast, so the rows themselves are not shuffled.
    """
    group, group_measure = group or entity, group_measure or measure
    per_entity = (
        df.where(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.count(F.lit(1)).alias("entity_count"), F.avg(measure).alias("entity_avg"))
    )
    medians = exact_quantiles(df, [group_measure], [0.5], keys=[group]).select(
        group, F.get("q", F.lit(0)).alias("_median")
    )
    return (
        df.join(broadcast_if_small(per_entity), entity, "left")
        .join(broadcast_if_small(medians), group, "left")
        .withColumn("diff_from_group_median", F.col(group_measure) - F.col("_median"))
        .drop("_median")
    )


def sample_rows(df: DataFrame, key: str, n: int = 12, seed: str | None = None) -> DataFrame:
    """A reproducible sample: the ``n`` rows with the smallest hash of their key."""
    text = F.col(key).cast("string")
    return df.orderBy(F.md5(F.concat(text, F.lit(seed)) if seed else text), key).limit(n)


def preview(df: DataFrame, order: Sequence[str], n: int = 10, placeholder: str = "N/A") -> DataFrame:
    """First rows as text, gaps shown as a placeholder."""
    head = df.orderBy(*order).limit(n)
    return head.select(*[F.coalesce(F.col(c).cast("string"), F.lit(placeholder)).alias(c) for c in df.columns])


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for every table."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out
