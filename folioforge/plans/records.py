"""Nested-source plan: raw documents to the cleaned record fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folioforge.functions import numeric, text
from folioforge.operators.clean import conform_to, empty_like, fill_medians, fill_placeholders, rename_aliases
from folioforge.operators.dedup import dedup_two_stage
from folioforge.operators.features import nested_record_features
from folioforge.operators.profile import iqr_cap
from folioforge.schemas import RECORD_FACT
from folioforge.session import cut_lineage

# Source names, placeholders and text lengths of the record fact.
ALIASES = {
    "key": "ol_key",
    "author_name": "author",
    "first_publish_year": "publish_year",
    "number_of_pages_median": "pages",
    "ratings_average": "avg_rating",
    "ratings_count": "rating_count",
    "_source": "api_source",
}
FIRST_ITEM_LENGTHS = {"author": 100, "publisher": 100, "isbn": None, "subject": 80}  # the identifier stays whole
NUMBERS = ("publish_year", "pages", "avg_rating", "rating_count")
PLACEHOLDERS = {
    "title": "Unknown Title",
    "author": "Unknown Author",
    "publisher": "Unknown Publisher",
    "subject": "General",
    "isbn": "",
    "ol_key": "",
    "api_source": "Unknown",
}
CAPPED = ("pages", "avg_rating", "rating_count")
TITLE_LENGTH = 255
SEQUENCE = "ingest_seq"


def flatten(raw: DataFrame) -> DataFrame:
    """Standard names, first item of list columns, numbers as doubles; missing columns become null."""
    if "title" not in raw.columns:
        raise ValueError("title is required")
    df = rename_aliases(raw, ALIASES)
    columns: dict[str, Column] = {}
    for c, length in FIRST_ITEM_LENGTHS.items():
        if c in df.columns:
            is_array = isinstance(df.schema[c].dataType, T.ArrayType)
            columns[c] = text.clean_text(text.first_item(F.col(c), is_array), length)
        else:
            columns[c] = F.lit(None).cast("string")
    for c in NUMBERS:
        columns[c] = numeric.to_number(F.col(c)) if c in df.columns else F.lit(None).cast("double")
    for c in ("ol_key", "api_source"):
        columns[c] = F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    columns["title"] = F.col("title").cast("string")
    if SEQUENCE not in df.columns:
        columns[SEQUENCE] = F.monotonically_increasing_id()
    return df.withColumns(columns)


def clean_records(raw: DataFrame) -> DataFrame:
    """Flatten, fill gaps (medians see the duplicates), dedup by key and then by identifier."""
    filled = fill_placeholders(fill_medians(flatten(raw), NUMBERS), PLACEHOLDERS)
    return dedup_two_stage(filled, ["ol_key"], ["isbn"], F.col("isbn") == "", [SEQUENCE])


def transform_records(raw: DataFrame, stage: bool = True) -> DataFrame:
    """The record fact. Tiers, flags and scores are derived before outliers are capped.

    ``stage`` writes the deduplicated rows once, as the capping passes over them several times.
    """
    if not raw.columns:
        return empty_like(raw.sparkSession, RECORD_FACT)
    featured = nested_record_features(clean_records(raw))
    capped = iqr_cap(cut_lineage(featured) if stage else featured, CAPPED)
    trimmed = capped.withColumns(
        {
            "title": F.substring(text.trimmed(F.col("title")), 1, TITLE_LENGTH),
            "api_source": text.trimmed(F.col("api_source")),
        }
    )
    return conform_to(trimmed, RECORD_FACT)


def empty_records(spark: SparkSession) -> DataFrame:
    return empty_like(spark, RECORD_FACT)
