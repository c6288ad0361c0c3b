"""Reference data: publishers by key prefix and exchange rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioforge.functions.numeric import convert
from folioforge.functions.text import key_prefix
from folioforge.session import literal_frame

# Publisher documents by identifier prefix, defaults, and rates used without a feed.
PUBLISHERS = [
    ("97815098", "Pan Macmillan", "UK"),
    ("97801410", "Penguin Books", "UK"),
    ("97817847", "Vintage Publishing", "UK"),
    ("97818452", "Robinson", "UK"),
    ("97818460", "Rider", "UK"),
    ("97803305", "Pan Books", "UK"),
    ("97817807", "Short Books Ltd", "UK"),
    ("97802413", "Penguin Life", "UK"),
]
UNMATCHED_PUBLISHER = ("Independent Publisher", "Unknown")
INCOMPLETE_PUBLISHER = ("Unknown Publisher", "Global")
FALLBACK_RATES = {"GBP": 0.78, "EUR": 0.92}

PUBLISHER_SCHEMA = "isbn_prefix string, publisher string, region string"
RATE_SCHEMA = "currency string, rate double"


def publishers(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The publisher lookup, from JSON documents or from the built-in list."""
    if path is not None:
        return spark.read.schema(PUBLISHER_SCHEMA).json(path)
    return literal_frame(spark, PUBLISHERS, PUBLISHER_SCHEMA)


def enrich_publisher(df: DataFrame, lookup: DataFrame, isbn: str = "isbn") -> DataFrame:
    """Add publisher and publisher_region by identifier prefix, with defaults on a miss."""
    side = lookup.select(
        F.col("isbn_prefix").alias("_prefix"),
        F.struct(
            F.coalesce("publisher", F.lit(INCOMPLETE_PUBLISHER[0])).alias("publisher"),
            F.coalesce("region", F.lit(INCOMPLETE_PUBLISHER[1])).alias("region"),
        ).alias("_hit"),
    )
    # No hint: the lookup may grow. Spark broadcasts it while it is small and splits hot prefixes beyond.
    joined = df.join(side, key_prefix(F.col(isbn)) == F.col("_prefix"), "left")
    return joined.withColumns(
        {
            "publisher": F.coalesce("_hit.publisher", F.lit(UNMATCHED_PUBLISHER[0])),
            "publisher_region": F.coalesce("_hit.region", F.lit(UNMATCHED_PUBLISHER[1])),
        }
    ).drop("_prefix", "_hit")


def rate_row(rates: DataFrame, currencies: Sequence[str]) -> DataFrame:
    """One row with a rate per currency; a currency missing from the table takes its fallback."""
    return rates.where(F.col("currency").isin(list(currencies))).agg(
        *[
            F.coalesce(F.max(F.when(F.col("currency") == c, F.col("rate"))), F.lit(FALLBACK_RATES.get(c))).alias(
                f"_rate_{c}"
            )
            for c in currencies
        ]
    )


def add_converted(df: DataFrame, rates: DataFrame, price: str = "price", currencies: Sequence[str] = ("GBP", "EUR")) -> DataFrame:
    """Add ``<price>_in_<currency>`` columns, two digits."""
    joined = df.crossJoin(F.broadcast(rate_row(rates, currencies)))  # one row
    return joined.withColumns(
        {f"{price}_in_{c.lower()}": convert(F.col(price), F.col(f"_rate_{c}")) for c in currencies}
    ).drop(*[f"_rate_{c}" for c in currencies])
