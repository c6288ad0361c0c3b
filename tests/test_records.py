import statistics

import pytest
from helpers import DOC_DEFAULTS, book, values
from pyspark.sql import functions as F

from folioforge.plans.records import clean_records, empty_records, flatten, transform_records
from folioforge.schemas import RECORD_DOC

pytestmark = pytest.mark.unit


@pytest.fixture(scope="module")
def fact(raw_records):
    return {r["ol_key"]: r for r in transform_records(raw_records).collect()}


def docs(spark, rows):
    return spark.createDataFrame([tuple({**DOC_DEFAULTS, **r}[n] for n in RECORD_DOC.names) for r in rows], RECORD_DOC)


def test_columns_and_types(raw_records):
    out = transform_records(raw_records)
    assert out.dtypes == empty_records(out.sparkSession).dtypes
    assert [dict(out.dtypes)[c] for c in ("publish_year", "pages", "avg_rating", "rating_count")] == ["double"] * 4


def test_first_items(fact):
    for n in (11, 12, 14):
        assert (fact[f"w{n:03d}"]["author"], fact[f"w{n:03d}"]["publisher"]) == (f"Writer {n}", f"Press {n % 4}")


def test_identifiers_stay_whole(spark):
    rows = [{"key": f"K{i}", "title": "T", "isbn": [f"9780000000000-part-{i}"]} for i in range(3)]
    assert values(clean_records(docs(spark, rows)), "isbn") == [(f"9780000000000-part-{i}",) for i in range(3)]


def test_no_nulls_and_placeholders(fact, raw_documents):
    assert all(v is not None for row in fact.values() for v in row)
    bare = fact["w013"]
    assert (bare["author"], bare["publisher"], bare["subject"], bare["isbn"]) == ("Unknown Author", "Unknown Publisher", "General", "")
    # Medians are taken over all rows, repeated ones included.
    for column, name in (("publish_year", "first_publish_year"), ("pages", "number_of_pages_median"), ("rating_count", "ratings_count")):
        assert bare[column] == statistics.median(d[name] for d in raw_documents if d[name] is not None)


def test_dedup_keeps_first(fact):
    assert sorted(fact) == ["w011", "w012", "w013", "w014", "w015"]
    assert fact["w011"]["title"] == "Volume 11"


def test_second_stage_keeps_blank_identifiers(spark):
    rows = [{"key": "K1", "title": "a", "isbn": ["1"]}, {"key": "K2", "title": "b", "isbn": ["1"]}, {"key": "K3", "title": "c"}, {"key": "K4", "title": "d", "isbn": []}]
    assert values(clean_records(docs(spark, rows)), "ol_key") == [("K1",), ("K3",), ("K4",)]


def test_labels_at_their_bounds(spark):
    """Values just under, at and just over each bound; medians and caps stay out of the way of the labels."""
    pages = {99: "Short (<100 pages)", 100: "Medium (100-300)", 299: "Medium (100-300)", 300: "Long (300-600)", 599: "Long (300-600)", 600: "Comprehensive (600+)"}
    ratings = {2.99: "Below Average (<3.0)", 3.0: "Average (3.0-4.0)", 3.99: "Average (3.0-4.0)", 4.0: "Good (4.0-4.5)", 4.49: "Good (4.0-4.5)", 4.5: "Excellent (4.5+)"}
    years = {1889: "1880s", 1890: "1890s", 1999: "1990s", 2000: "2000s", 2009: "2000s", 2010: "2010s"}
    rows = [
        book(i, number_of_pages_median=p, ratings_average=r, first_publish_year=y)
        for i, (p, r, y) in enumerate(zip(pages, ratings, years))
    ]
    out = sorted(transform_records(docs(spark, rows)).collect(), key=lambda r: r["ol_key"])
    assert [r["page_tier"] for r in out] == list(pages.values())
    assert [r["rating_category"] for r in out] == list(ratings.values())
    assert [r["publish_decade"] for r in out] == list(years.values())
    assert [r["is_highly_rated"] for r in out] == [int(r >= 4.0) for r in ratings]
    assert {r["title_word_count"] for r in out} == {2}


def test_missing_columns(spark):
    df = spark.createDataFrame([("K1", "T")], "key string, title string")
    row = transform_records(df).first()
    assert (row["publish_year"], row["publish_decade"], row["author"], row["api_source"]) == (0.0, "0s", "Unknown Author", "Unknown")
    with pytest.raises(ValueError):
        flatten(df.drop("title"))


def test_empty_input(spark):
    empty = transform_records(spark.createDataFrame([], RECORD_DOC))
    assert empty.count() == 0 and empty.dtypes == empty_records(spark).dtypes
    assert transform_records(spark.range(1).select()).count() == 0


def test_capping_follows_tiers(spark):
    rows = [{"key": f"K{i}", "title": "T", "number_of_pages_median": 200 + i} for i in range(20)] + [
        {"key": "BIG", "title": "T", "number_of_pages_median": 9000}
    ]
    big = transform_records(docs(spark, rows)).where(F.col("ol_key") == "BIG").first()
    assert big["page_tier"] == "Comprehensive (600+)" and big["pages"] == 230.0
