"""Feature columns of catalog rows, catalog increments and nested-source records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioforge.functions import numeric, text, tiers


def catalog_features(df: DataFrame) -> DataFrame:
    """The derived columns of an imputed, deduplicated catalog."""
    priced = df.withColumn("discount_amount", numeric.discount_amount(F.col("old_price"), F.col("price")))
    priced = priced.withColumn("discount_pct", numeric.discount_pct(F.col("discount_amount"), F.col("old_price")))
    return priced.withColumns(
        {
            "price_gbp": numeric.convert(F.col("price")),
            "value_score": numeric.value_score(F.col("rating"), F.col("price")),
            "is_bestseller": F.coalesce(F.col("rating") >= numeric.BESTSELLER_RATING, F.lit(False)),
            "isbn13_valid": text.digits_between(F.col("isbn"), 13, 13),
            "title_length": text.title_length(F.col("title")),
            "word_count": text.word_count(F.col("title")),
            "price_tier": tiers.price_tier(F.col("price")),
            "discount_tier": tiers.discount_tier(F.col("discount_pct")),
        }
    )


def text_features(df: DataFrame, column: str) -> DataFrame:
    """Title shape: length, words, characters per word, subtitle mark."""
    col = F.col(column)
    counted = df.withColumns(
        {
            "title_length": text.title_length(col),
            "word_count": text.word_count(col),
            "has_subtitle": text.has_subtitle(col),
        }
    )
    # A second step, so the words are split once per row.
    return counted.withColumn("chars_per_word", text.chars_per_word(F.col("title_length"), F.col("word_count")))


# What a single added record takes for a missing or unusable input.
RECORD_TEXT_DEFAULTS = {
    "title": "Untitled",
    "author": "Unknown",
    "format": "Paperback",
    "category": "General",
    "isbn": "",
}
RECORD_MISSING_PRICE = 0.0
RECORD_BAD_PRICE = 10.0
RECORD_RATING = 4.0
RECORD_PRICE_FLOOR = 0.01


def record_features(df: DataFrame) -> DataFrame:
    """Features of added records, given as text columns; absent and bad inputs take defaults.

    The old price is never below the price, and prices are floored before they divide.
    """
    for column in (*RECORD_TEXT_DEFAULTS, "price", "old_price", "rating", "cover_url"):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast("string"))
    df = df.withColumns(
        {c: text.trimmed(F.coalesce(F.col(c), F.lit(v))) for c, v in RECORD_TEXT_DEFAULTS.items()}
        | {
            "price": F.when(F.col("price").isNull(), RECORD_MISSING_PRICE).otherwise(
                F.coalesce(numeric.to_number(F.col("price")), F.lit(RECORD_BAD_PRICE))
            ),
            "rating": F.coalesce(numeric.to_number(F.col("rating")), F.lit(RECORD_RATING)),
        }
    )
    df = df.withColumn("old_price", F.greatest(numeric.to_number(F.col("old_price")), F.col("price")))
    floored = df.withColumns(
        {
            "_price": F.greatest(F.col("price"), F.lit(RECORD_PRICE_FLOOR)),
            "_old": F.greatest(F.col("old_price"), F.lit(RECORD_PRICE_FLOOR)),
        }
    )
    featured = catalog_features(floored).withColumns(
        {
            "discount_pct": numeric.discount_pct(F.col("discount_amount"), F.col("_old")),
            "value_score": numeric.value_score(F.col("rating"), F.col("_price")),
            "currency": F.lit("$"),
        }
    )
    return featured.drop("_price", "_old")


def append_records(catalog: DataFrame, records: DataFrame) -> DataFrame:
    """Engineer the added records and put them ahead of the catalog."""
    return record_features(records).unionByName(catalog, allowMissingColumns=True)


def nested_record_features(df: DataFrame) -> DataFrame:
    """The derived columns of deduplicated nested-source records."""
    return df.withColumns(
        {
            "publish_decade": numeric.decade(F.col("publish_year")),
            "page_tier": tiers.page_tier(F.col("pages")),
            "is_highly_rated": F.coalesce(F.col("avg_rating") >= numeric.HIGH_RATING, F.lit(False)).cast("int"),
            "rating_category": tiers.rating_category(F.col("avg_rating")),
            "has_isbn": text.digits_between(F.col("isbn"), 10, 13).cast("int"),
            "popularity_score": numeric.popularity_score(F.col("avg_rating"), F.col("rating_count")),
            "title_word_count": text.word_count(F.col("title")),
        }
    )
