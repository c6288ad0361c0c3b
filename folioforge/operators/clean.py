"""Cleaning: renames, schema conformance, coercion, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioforge.functions import numeric, text
from folioforge.operators.quantiles import mode_row
from folioforge.operators.wide_profile import wide_profile
from folioforge.session import cut_lineage

# Column aliases, placeholders and defaults of the catalog.
CATALOG_ALIASES = {"name": "title", "book_depository_stars": "rating", "img_paths": "img_path_raw"}
CATALOG_TEXT_COLUMNS = ("author", "format", "category", "currency", "image")
PLACEHOLDER = "Unknown"
DEFAULT_RATING = 4.0
CATALOG_DEFAULTS = {
    "price": 10.0,
    "old_price": 10.0,
    "rating": 4.0,
    "author": "Unknown",
    "format": "Unknown",
    "category": "Unknown",
    "isbn": "Unknown",
}


def rename_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename a column only when it is there and its new name is not taken."""
    usable = {old: new for old, new in aliases.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(usable)


def conform(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add every missing column with its typed default."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type; missing ones are null, bad values too."""
    columns = [
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns)


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that are missing (schema only, runs no job)."""
    return sorted(set(required) - set(df.columns))


def coerce_numbers(df: DataFrame, columns: Sequence[str], money: Sequence[str] = ()) -> DataFrame:
    """Text to double, bad text to null; ``money`` columns lose their currency marks first."""
    return df.withColumns(
        {c: (numeric.money_to_number if c in money else numeric.to_number)(F.col(c)) for c in columns}
    )


def drop_invalid(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(critical))


def fill_placeholders(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def add_batch_time(df: DataFrame, run_ts: str, name: str = "loaded_at") -> DataFrame:
    """The batch time is an argument, so a re-run gives the same rows."""
    return df.withColumn(name, F.lit(run_ts).cast("timestamp"))


def standardise_catalog(raw: DataFrame) -> DataFrame:
    """Standard names, trimmed title, numbers as doubles, key as trimmed text."""
    df = rename_aliases(raw, CATALOG_ALIASES)
    df = coerce_numbers(df, ["price", "old_price", "rating"], money=["price", "old_price"])
    return df.withColumns({"title": text.clean_text(F.col("title")), "isbn": text.trimmed(F.col("isbn"))})


def impute_catalog(df: DataFrame) -> DataFrame:
    """Fill the gaps of a standardised catalog.

    Old price from price (before price itself is filled), price by its median, rating by its mode,
    text by placeholder, key by the empty text. Median and mode are two numbers that are known before the plan is made.
    """
    # Both pass over two columns several times: those are parsed once and kept apart.
    numbers = cut_lineage(df.select("price", "rating"))
    median = wide_profile(numbers, ["price"], [0.5])["price"].quantiles[0]
    mode = mode_row(numbers, "rating", "mode").first()["mode"]
    filled = df.withColumns(
        {
            "old_price": F.coalesce("old_price", "price"),
            "price": F.coalesce("price", F.lit(median).cast("double")),
            "rating": F.coalesce("rating", F.lit(mode).cast("double"), F.lit(DEFAULT_RATING)),
        }
    )
    if "isbn" in filled.columns:
        filled = filled.withColumn("isbn", F.coalesce("isbn", F.lit("")))
    return fill_placeholders(filled, dict.fromkeys(CATALOG_TEXT_COLUMNS, PLACEHOLDER))


def fill_medians(df: DataFrame, columns: Sequence[str], when_empty: float = 0.0) -> DataFrame:
    """Numeric gaps take the column median, or ``when_empty`` when the column has no value."""
    medians = wide_profile(df, columns, [0.5])
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(medians[c].quantiles[0]).cast("double"), F.lit(when_empty)) for c in columns}
    )


