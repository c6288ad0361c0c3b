"""Declared schemas of sources and targets."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """A struct from ``name type, ...``, usable before a session exists."""
    fields = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Column names and types of the tables.
RAW_CATALOG = _struct(
    "name string, book_depository_stars string, img_paths string, author string, format string, category string, "
    "price string, old_price string, currency string, isbn string, image string"
)

RECORD_DOC = _struct(
    "key string, title string, author_name array<string>, first_publish_year bigint, publisher array<string>, "
    "isbn array<string>, number_of_pages_median bigint, ratings_average double, ratings_count bigint, "
    "subject array<string>"
)

RECORD_PAGE = T.StructType(
    [T.StructField("numFound", T.LongType()), T.StructField("docs", T.ArrayType(RECORD_DOC))]
)

RECORD_FACT = _struct(
    "ol_key string, isbn string, title string, author string, publisher string, subject string, "
    "publish_year double, publish_decade string, pages double, page_tier string, avg_rating double, "
    "rating_count double, is_highly_rated int, rating_category string, has_isbn int, popularity_score double, "
    "title_word_count int, api_source string"
)

ETL_FACT = _struct(
    "isbn string, title string, author string, format string, category string, price double, old_price double, "
    "rating double, discount_amount double, discount_pct double, price_gbp double, value_score double, "
    "is_bestseller int, price_tier string"
)

RUN_LOG = _struct(
    "run_id string, run_timestamp timestamp, sources_attempted int, records_extracted bigint, "
    "records_after_transform bigint, records_loaded bigint, load_strategy string, total_ms bigint, "
    "status string, error_msg string"
)

ETL_EXECUTION_LOG = _struct(
    "exec_id string, source string, load_strategy string, extracted_records bigint, transformed_records bigint, "
    "loaded_records bigint, execution_time_ms bigint, status string, timestamp timestamp"
)

CDC_AUDIT = _struct(
    "key_id string, action string, column_changed string, old_value string, new_value string, timestamp timestamp"
)

EVENT_MESSAGE = _struct(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
