import pytest
from helpers import values
from pyspark.sql import functions as F

from folioforge.operators import clean, dedup, features
from folioforge.operators.quantiles import mode_row
from folioforge.plans.catalog import prepare_catalog

pytestmark = pytest.mark.unit


def test_rename_only_when_target_is_free(spark):
    df = spark.createDataFrame([(1, 2, 3)], "name int, title int, img_paths int")
    assert clean.rename_aliases(df, clean.CATALOG_ALIASES).columns == ["name", "title", "img_path_raw"]


def test_conform_adds_typed_defaults(spark):
    df = clean.conform(spark.createDataFrame([("a",)], "title string"), clean.CATALOG_DEFAULTS)
    row = df.first()
    assert (row["price"], row["old_price"], row["rating"], row["author"], row["isbn"]) == (10.0, 10.0, 4.0, "Unknown", "Unknown")
    assert clean.require_columns(df, ["title", "pages"]) == ["pages"]


def test_fill_order(spark):
    rows = [(1, "1", 10.0, None, 4.0), (2, "2", None, None, None), (3, "3", 30.0, 40.0, 4.0), (4, "4", None, 15.0, 3.0)]
    df = spark.createDataFrame(rows, "ingest_seq int, isbn string, price double, old_price double, rating double")
    out = {r["ingest_seq"]: r for r in clean.impute_catalog(df).collect()}
    assert out[1]["old_price"] == 10.0
    # Both prices missing: the old price is filled before the price, so it stays missing.
    assert (out[2]["price"], out[2]["old_price"], out[2]["rating"]) == (20.0, None, 4.0)
    assert (out[4]["price"], out[4]["old_price"]) == (20.0, 15.0)


def test_both_prices_missing_gives_no_discount(spark):
    df = spark.createDataFrame([(1, "1", "t", None, None, "4"), (2, "2", "t", "$8", None, None)],
                               "ingest_seq int, isbn string, name string, price string, old_price string, book_depository_stars string")
    out = {r["ingest_seq"]: r for r in prepare_catalog(df).collect()}
    assert (out[1]["discount_amount"], out[1]["discount_pct"], out[1]["discount_tier"]) == (None, 0.0, "No Discount")


def test_median_of_empty_column_uses_default(spark):
    df = spark.createDataFrame([(1, None)], "k int, v double")
    assert clean.fill_medians(df, ["v"]).first()["v"] == 0.0


@pytest.mark.parametrize("data, expected", [([1.0, 1.0, 2.0, 2.0], 1.0), ([3.0], 3.0), ([None], None), ([2.0, 5.0, 5.0], 5.0)])
def test_mode(spark, data, expected):
    df = spark.createDataFrame([(v,) for v in data], "v double")
    assert mode_row(df, "v").first()["mode"] == expected


def test_keep_first_by_order_not_by_position(spark):
    rows = [(3, "a"), (1, "a"), (2, "b"), (5, None), (4, " "), (6, "")]
    df = spark.createDataFrame(rows, "ingest_seq int, isbn string").repartition(4)
    assert values(dedup.dedup_by_key(df, "isbn", ["ingest_seq"])) == [(1, "a"), (2, "b"), (4, "")]
    assert values(dedup.dedup_by_key(df, "isbn", ["ingest_seq"], keep_blank=True)) == [(1, "a"), (2, "b"), (4, ""), (5, ""), (6, "")]


def test_dedup_is_idempotent(spark):
    df = spark.range(200).select((F.col("id") % 17).cast("string").alias("isbn"), F.col("id").alias("ingest_seq"))
    once = dedup.dedup_by_key(df, "isbn", ["ingest_seq"])
    assert values(dedup.dedup_by_key(once, "isbn", ["ingest_seq"])) == values(once)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 10, "hot").otherwise("cold").alias("k"), "id")
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Partial") > plan.index("Exchange")


def test_duplicate_counts_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "k string, v int")
    assert values(dedup.duplicate_counts(df, {"row": ["k", "v"], "key": ["k"]})) == [("key", 2), ("row", 1)]


def test_record_features_defaults(spark):
    rows = [("T", None, "bad", None, None), (None, "20", "10", "5.5", "12"), ("T", "8", None, "x", "9")]
    df = spark.createDataFrame(rows, "title string, old_price string, price string, rating string, isbn string")
    out = features.record_features(df).collect()
    assert [r["price"] for r in out] == [10.0, 10.0, 0.0]
    assert [r["old_price"] for r in out] == [10.0, 20.0, 8.0]
    assert [r["rating"] for r in out] == [4.0, 5.5, 4.0]
    assert [r["title"] for r in out] == ["T", "Untitled", "T"]
    assert [r["discount_pct"] for r in out] == [0.0, 50.0, 100.0]
    assert out[2]["value_score"] == 400.0
    assert {(r["author"], r["format"], r["category"]) for r in out} == {("Unknown", "Paperback", "General")}


def test_old_price_is_raised_to_price(spark):
    df = spark.createDataFrame([("T", "5", "9")], "title string, old_price string, price string")
    row = features.record_features(df).first()
    assert (row["old_price"], row["discount_amount"], row["discount_tier"]) == (9.0, 0.0, "No Discount")
