import json

import pytest
from helpers import values
from pyspark.sql import functions as F

from folioforge.operators import quality
from folioforge.plans.records import transform_records
from folioforge.sources.sinks import report_json, write_report

pytestmark = pytest.mark.quality
SCHEMA = "ol_key string, title string, author string, publish_year double, avg_rating double"


def statuses(spark, rows):
    return {r["check"]: r["status"] for r in quality.gate_checks(spark.createDataFrame(rows, SCHEMA), quality.RECORD_RULES).collect()}


def test_clean_records_pass_and_report_is_written(spark, raw_records, tmp_path):
    checks = quality.gate_checks(transform_records(raw_records), quality.RECORD_RULES)
    assert {r["status"] for r in checks.collect()} == {"PASS"} and checks.count() == 5
    assert quality.gate_passed(checks)
    write_report(checks, str(tmp_path / "report"), "2024-01-01T00:00:00")
    report = json.loads(spark.read.text(str(tmp_path / "report")).first()[0])
    assert report["passed"] is True and len(report["checks"]) == 5


def test_many_nulls_fail(spark):
    got = statuses(spark, [("K1", None, None, None, None), ("K2", None, None, None, None)])
    assert got["Critical columns null rate <= 0.05"] == "FAIL"


def test_null_rate_at_the_limit_passes(spark):
    rows = [("K1", None, "a", 2000.0, 4.0)] + [(f"K{i}", "t", "a", 2000.0, 4.0) for i in range(2, 5)]
    assert statuses(spark, rows)["Critical columns null rate <= 0.05"] == "PASS"


def test_ranges(spark):
    got = statuses(spark, [("K1", "t", "a", 2020.0, 9.9)])
    assert [s for c, s in got.items() if "Rating range" in c] == ["FAIL"]
    edge = statuses(spark, [("K1", "t", "a", 1000.0, 0.0), ("K2", "t", "a", 2030.0, 5.0), ("K3", "t", "a", None, None)])
    assert [s for c, s in edge.items() if "range" in c] == ["PASS", "PASS"]
    assert [s for c, s in statuses(spark, [("K1", "t", "a", 999.0, 1.0)]).items() if "publish_year" in c] == ["FAIL"]


def test_key_uniqueness_counts_null_as_a_value(spark):
    assert statuses(spark, [(None, "t", "a", 2000.0, 4.0)] * 2)["Primary key (ol_key) uniqueness"] == "FAIL"


def test_no_rows_stops_at_first_check(spark):
    assert statuses(spark, []) == {"Row count >= 1": "FAIL"}


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("t",)], "title string")
    assert values(quality.gate_checks(df, quality.RECORD_RULES), "status") == [("PASS",), ("PASS",)]


def test_graded_report(spark):
    rows = [(i, None if i < 2 else "a", float(i), i % 20 != 0) for i in range(20)] + [(19, "a", 19.0, True)]
    df = spark.createDataFrame(rows, "k int, s string, v double, isbn13_valid boolean")
    report = quality.validate_report(df, numeric=["v"])
    got = {(r["check"], r["column_name"]): (r["status"], r["value"]) for r in report.collect()}
    assert got[("Null Check", "s")] == ("WARN", 9.52)
    assert got[("Null Check", "k")] == ("PASS", 0.0)
    assert got[("Schema Validation", "v")] == ("PASS", 0.0)
    assert got[("Outlier Detection", "v")] == ("PASS", 0.0)
    assert got[("Duplicate Check", "ALL")] == ("WARN", 1.0)
    assert got[("ISBN-13 Validation", "isbn")] == ("WARN", 4.76)
    totals = quality.report_totals(report).first()
    assert (totals["total"], totals["passed"], totals["warned"], totals["failed"], totals["pass_rate"], totals["gate"]) == (8, 5, 3, 0, 62.5, "FAIL")


@pytest.mark.parametrize("pct, expected", [(4.99, "PASS"), (5.0, "WARN"), (19.99, "WARN"), (20.0, "FAIL")])
def test_grades(spark, pct, expected):
    assert spark.range(1).select(quality.graded(F.lit(pct), quality.NULL_GRADES)).first()[0] == expected


RULES = {"positive": lambda: F.col("v") > 0, "named": lambda: F.col("s").isNotNull()}


def test_split_and_reprocess(spark):
    rules = {k: f() for k, f in RULES.items()}
    df = spark.createDataFrame([(1, 1.0, "a"), (2, -1.0, None), (3, None, "b")], "k int, v double, s string")
    good, bad = quality.split_rows(df, rules)
    assert values(good) == [(1, 1.0, "a")]
    assert values(bad, "k", "reasons") == [(2, ["positive", "named"]), (3, ["positive"])]
    fixed, still = quality.reprocess(bad, df.schema, lambda d: d.withColumn("v", F.lit(5.0)), rules)
    assert values(fixed) == [(3, 5.0, "b")] and values(still, "k") == [(2,)]


def test_load_verify(spark):
    a, b = spark.range(3), spark.range(2)
    assert values(quality.load_verify(a, b, ["id"]), "check", "status") == [("required_columns", "PASS"), ("row_count", "FAIL")]


def test_report_json_of_failures(spark):
    report = spark.createDataFrame([("x", "FAIL")], "check string, status string")
    assert json.loads(report_json(report, "t").first()[0])["passed"] is False


def test_two_rating_columns_are_checked_apart(spark):
    df = spark.createDataFrame([("k", 99.0, 4.0)], "ol_key string, rating double, avg_rating double")
    rules = quality.GateRules("ol_key", (), {"rating": (0.0, 5.0), "avg_rating": (0.0, 5.0)})
    got = {r["check"]: r["status"] for r in quality.gate_checks(df, rules).collect()}
    assert got["rating range [0 - 5]"] == "FAIL" and got["avg_rating range [0 - 5]"] == "PASS"


def test_report_covers_all_columns(spark):
    columns = [f"c{i}" for i in range(12)]
    df = spark.range(20).select(F.col("id").alias("ingest_seq"), *[F.lit(float(i)).alias(c) for i, c in enumerate(columns)])
    report = quality.validate_report(df, valid_flag=None)
    assert report.where("check = 'Null Check'").count() == report.where("check = 'Outlier Detection'").count() == 12
    assert report.where("check = 'Duplicate Check'").first()["value"] == 19.0
