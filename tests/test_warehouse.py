import pytest
from helpers import values
from pyspark.sql import functions as F

from folioforge.operators import olap, warehouse
from folioforge.operators.features import catalog_features

pytestmark = pytest.mark.unit


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [("1", "T1", "Zoe", "Art-Modern", "Paperback", 9.0, 10.0, 4.5), ("2", "T2", "Unknown", "Cooking", "Hardback", 30.0, 30.0, 3.0),
            ("3", None, "Amy", "Art-Modern", None, 20.0, 40.0, 5.0), ("4", "T4", "Amy", None, "Paperback", 5.0, 5.0, 2.0)]
    df = spark.createDataFrame(rows, "isbn string, title string, author string, category string, format string, price double, old_price double, rating double")
    return catalog_features(df)


def test_dense_keys_over_many_partitions(spark):
    names = spark.range(5000).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name")).repartition(13)
    out = warehouse.dense_keys(names, "key", ["name"])
    bad = out.where(F.concat(F.lit("n"), F.lpad((F.col("key") - 1).cast("string"), 6, "0")) != F.col("name"))
    assert out.count() == 5000 and bad.isEmpty()


def test_dimensions(catalog):
    assert values(warehouse.dim_category(catalog)) == [(1, "Art-Modern", "Art"), (2, "Cooking", "Cooking")]
    assert values(warehouse.dim_publisher(catalog)) == [(1, "Art-Modern House", "UK"), (2, "Cooking House", "UK")]
    assert values(warehouse.dim_format(catalog)) == [(1, "Hardback"), (2, "Paperback")]


def test_insert_or_ignore_keeps_keys(spark):
    old = spark.createDataFrame([(4, "b")], "key long, name string")
    new = spark.createDataFrame([("c",), ("b",), ("a",), ("a",), (None,)], "name string")
    once = warehouse.dim_upsert(old, new, "key", "name")
    assert values(once) == [(4, "b", False), (5, "a", True), (6, "c", True)]
    again = warehouse.dim_upsert(once, new, "key", "name")
    assert values(again, "key", "name") == [(4, "b"), (5, "a"), (6, "c")]
    assert values(warehouse.dim_upsert(old.limit(0), new, "key", "name"), "key", "name") == [(1, "a"), (2, "b"), (3, "c")]


def test_lookup_default(spark, catalog):
    dim = spark.createDataFrame([(1, "Cooking")], "category_key long, category_name string")
    for default in (-1, 1):
        out = warehouse.lookup_key(catalog, dim, "category", "category_name", "category_key", default)
        assert values(out, "isbn", "category_key") == [("1", default), ("2", 1), ("3", default), ("4", default)]


def test_3nf(catalog):
    tables = warehouse.books_3nf(catalog)
    assert values(tables["authors"]) == [(-1, "Unknown"), (1, "Amy"), (2, "Zoe")]
    assert values(tables["publishers"], "publisher_name") == [("Art-Modern Publishing",), ("Cooking Publishing",), ("Unknown",)]
    assert values(tables["books"], "isbn", "author_id", "publisher_id", "category_id") == [("1", 2, 1, 1), ("2", -1, 2, 2), ("4", 1, -1, -1)]


def test_star(catalog):
    tables = warehouse.star_schema(catalog)
    fact = tables["fact_book_sales"]
    assert values(fact, "isbn", "category_key", "format_key", "is_bestseller") == [("1", 1, 2, 1), ("2", 2, 1, 0), ("3", 1, -1, 1)]
    keys = {"dim_category": "category_key", "dim_format": "format_key", "dim_publisher": "publisher_key", "dim_time": "time_key"}
    dims = {name: (tables[name], key, key) for name, key in keys.items()}
    assert values(warehouse.fk_integrity(fact, dims)) == [(name, 0) for name in sorted(keys)]
    assert olap.star(fact, {key: (tables[name], key) for name, key in keys.items()}).count() == fact.count() == 3
    known = {**dims, "dim_format": (tables["dim_format"].where("format_key > 0"), "format_key", "format_key")}
    assert ("dim_format", 1) in values(warehouse.fk_integrity(fact, known))
    assert values(tables["dim_time"], "time_key")[0] == (202401,) and tables["dim_time"].count() == 6


def test_time_dimension(spark):
    df = spark.sql("SELECT timestamp'2023-11-15 10:00:00' AS d UNION ALL SELECT timestamp'2024-02-01 00:00:00'")
    assert values(warehouse.dim_time(df, "d")) == [(202311, 2023, "Q4", 11), (202312, 2023, "Q4", 12), (202401, 2024, "Q1", 1), (202402, 2024, "Q1", 2)]


def test_etl_fact_order_and_flag(catalog):
    fact = warehouse.etl_fact(catalog.drop("old_price"))
    assert fact.columns == ["isbn", "title", "author", "format", "category", "price", "rating", "discount_amount", "discount_pct", "price_gbp", "value_score", "is_bestseller", "price_tier"]
    assert dict(fact.dtypes)["is_bestseller"] == "int"


def test_cube_totals_equal_rollup_totals(spark):
    df = spark.range(300).select((F.col("id") % 3).cast("string").alias("a"), (F.col("id") % 5).cast("string").alias("b"), F.col("id").cast("double").alias("p"), F.lit(1.0).alias("r"))
    cube, roll = olap.cube_full(df, ["a", "b"], "p", "r"), olap.rollup_total(df, ["a", "b"], "p", "r")
    assert values(cube.where("grouping_id in (0, 1, 3)")) == values(roll)
    assert values(olap.cube_slice(cube, ["a", "b"], {"b": "2"}), "a", "b", "row_count") == [(None, "2", 60)]
    assert values(olap.cube_slice(cube, ["a", "b"], {}), "row_count") == [(300,)]
    for wanted in ({"b": "2"}, {}, {"a": "1", "b": "3"}):
        assert values(olap.cube_cells(df, ["a", "b"], wanted, "p", "r")) == values(olap.cube_slice(cube, ["a", "b"], wanted))
    assert olap.cube_topn(df, ["a"], ["b"], 2, 2, "p", "r").count() == 4


def test_read_only_sql(spark):
    olap.register_views(spark, {"wh_t": spark.range(5)})
    assert olap.run_sql(spark, "-- note\nSELECT count(*) AS n FROM wh_t WHERE id > :low;", {"low": 2}).first()["n"] == 2
    assert olap.run_sql(spark, "SELECT 'a--b /* c */' AS s -- note").first()["s"] == "a--b /* c */"
    for bad in ("DROP TABLE wh_t", "CREATE TABLE t2 AS SELECT 1", "SET x=1", "INSERT INTO wh_t VALUES (1)", "WITH x AS (SELECT 1) INSERT INTO wh_t SELECT * FROM x"):
        with pytest.raises(ValueError):
            olap.run_sql(spark, bad)
    assert olap.run_sql(spark, "(SELECT `insert`, r'\\' AS b FROM VALUES (1) AS t(`insert`)) -- delete").first()["insert"] == 1
    for bad in ("", "/* SELECT */ DROP TABLE t", "WITH x AS (SELECT r'\\') INSERT INTO t SELECT '", "FROM t INSERT INTO u SELECT 1", "with x as (select 1) delete from t"):
        assert not olap.reads_only(bad)
