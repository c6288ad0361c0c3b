"""Loads that see part of their target: indexed checksums, bucketed tables, cube increments, pruned backfill, stream state."""

import json

import pytest
from helpers import values
from pyspark.sql import functions as F, types as T

from folioforge.functions.rounding import exact_mean, exact_sum
from folioforge.operators import cdc, olap, profile
from folioforge.operators.wide_profile import wide_profile
from folioforge.plans import catalog, recovery
from folioforge.plans.pipeline import run_catalog_pipeline
from folioforge.plans.runlog import read_runs
from folioforge.schemas import ETL_EXECUTION_LOG
from folioforge.sources import bucketed, cube_store, membership, sinks
from folioforge.sources.tables import catalog_raw
from folioforge.streaming import jobs, state

pytestmark = pytest.mark.mock


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> int:
    return plan(df).split("Initial Plan")[0].count("FileScan")


# Sums


@pytest.mark.parametrize("numbers", [[2e-13, 2e-13], [1.2345678901234e-10] * 2, [1e23, 1e23, 1.0], [1e300, 5.0], [0.1] * 10, [None, 3.5]])
def test_sums_lose_nothing_at_any_scale(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    total = sum(x for x in numbers if x is not None)
    row = df.agg(exact_sum(F.col("x")).alias("s"), exact_mean(F.col("x")).alias("m")).first()
    assert row["s"] == pytest.approx(total, rel=1e-12)
    assert row["m"] == pytest.approx(total / sum(x is not None for x in numbers), rel=1e-12)


@pytest.mark.parametrize("scale", [1e-13, 1.0, 1e23])
def test_capped_sums_at_any_scale(spark, scale):
    df = spark.createDataFrame([(scale * x,) for x in [*range(1, 21), 1000]], "x double")
    found = wide_profile(df, ["x"], (0.25, 0.75), fence_factor=1.5, sums=True)["x"]
    assert found.outliers == 1 and found.fences[1] == pytest.approx(31 * scale)
    assert found.capped_sum == pytest.approx((210 + 31) * scale)


# Profiles


def test_profile_in_two_scans(spark, tmp_path):
    rng = __import__("random").Random(1)
    rows = [(rng.gauss(0, 1), float(rng.randint(0, 3)), None if i % 7 else rng.expovariate(1), float("nan") if i % 3 else 2.0) for i in range(5000)]
    spark.createDataFrame(rows, "a double, b double, c double, d double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    import numpy as np

    reads = spark.sparkContext.accumulator(0)
    probs, columns = (0.25, 0.5, 0.75, 0.9), ["a", "b", "c", "d"]
    count = F.udf(lambda x: (reads.add(1), x)[1], "double").asNondeterministic()
    found = wide_profile(df.select(count("a").alias("a"), "b", "c", "d"), columns, probs, moments=True, fence_factor=1.5)
    assert reads.value == 2 * len(rows)  # each row is read twice
    for i, c in enumerate(columns):
        own = np.array([r[i] for r in rows if r[i] is not None and r[i] == r[i]])
        assert found[c].n == len(own)
        assert found[c].quantiles == pytest.approx(np.quantile(own, probs).tolist(), rel=1e-12)
        q1, q3 = np.quantile(own, 0.25), np.quantile(own, 0.9)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert found[c].outliers == int(((own < low) | (own > high)).sum())
        assert found[c].moments["mean"] == pytest.approx(own.mean())


def test_profile_when_the_sketch_misses(spark, monkeypatch):
    monkeypatch.setattr("folioforge.operators.wide_profile.ACCURACY", 3)
    monkeypatch.setattr("folioforge.operators.wide_profile.REACH", 0)
    df = spark.range(0, 1001, 1, 8).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    found = wide_profile(df, ["x"], (0.25, 0.5, 0.75), fence_factor=0.1)["x"]
    assert found.quantiles == [250.0**2, 500.0**2, 750.0**2]
    low, high = found.fences
    assert found.outliers == sum(not low <= i * i <= high for i in range(1001))


def test_profile_without_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert profile.iqr_outliers(df, ["x", "y"]).select("column_name", "outliers").collect() == [("x", 0), ("y", 0)]
    assert [r["column_name"] for r in profile.numeric_profile(df, ["x", "y"]).collect()] == ["y"]
    assert profile.iqr_bounds(df, ["x"]).first() == (None, None)


def test_stage_metrics_read_the_file_once(spark, tmp_path):
    header = ["name", "book_depository_stars", "img_paths", "author", "format", "category", "price", "old_price", "currency", "isbn", "image"]
    rows = [(f"t{i}", "4.5", "p", None if i % 3 else "a", "f", "c", None if i % 5 == 0 else f"${i}", None, "$", str(i % 30), "x", i) for i in range(1, 61)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in header) + ", ingest_seq long").write.parquet(str(tmp_path / "raw"))
    reads = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: (reads.add(1), x)[1], "string").asNondeterministic()
    raw = spark.read.parquet(str(tmp_path / "raw")).withColumn("name", count("name"))
    metrics, columns = catalog.stage_metrics(raw)
    row = profile.transform_summary(metrics).first()
    assert reads.value == 60
    assert (row["input_rows"], row["output_rows"], row["dupes_removed"]) == (60, 30, 30)
    assert columns["featured"] > columns["standardised"]
    # 12 prices, 12 old prices beside them stay empty, 48 old prices and 40 authors are filled.
    assert row["nulls_filled"] == 12 + 48 + 40


# Indexed checksums


def test_batch_opens_only_files_that_may_hold_it(spark, tmp_path):
    path, columns = str(tmp_path / "t"), ["id", "v"]
    rows = spark.range(4000).select("id", F.lit("x").alias("v"))
    assert membership.append_new(spark, rows, path, columns, n_files=32) == 4000
    batch = spark.createDataFrame([(7, "x"), (8, "y"), (5000, "x"), (5000, "x")], "id long, v string")
    hashed = batch.withColumn("h", membership.row_sha256(columns)).select(membership.hash_key(F.col("h")).alias("hash_key"))
    assert 1 <= len(membership.files_that_may_hold(spark, path, hashed)) <= 3
    assert values(membership.new_rows(spark, batch, path, columns), "id", "v") == [(5000, "x"), (8, "y")]
    assert [membership.append_new(spark, batch, path, columns) for _ in range(2)] == [2, 0]
    assert membership.read_indexed(spark, path).count() == 4002


def test_failed_append_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    membership.append_new(spark, spark.range(10), path, ["id"])
    with pytest.raises(Exception):
        membership.append_new(spark, spark.range(20).withColumn("v", F.raise_error(F.lit("no"))), path, ["id"])
    assert membership.read_indexed(spark, path).count() == 10


# Bucketed tables


def test_bucketed_joins_need_no_exchange(spark, tmp_path):
    old = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    new = spark.range(200, 1200).select("id", (F.col("id") % 5).alias("v"))
    a = bucketed.write_bucketed(old, "t_old", str(tmp_path / "a"), ["id"], 4)
    b = bucketed.write_bucketed(new, "t_new", str(tmp_path / "b"), ["id"], 4)
    diff = cdc.snapshot_diff(a, b, ["id"], missing_keys=False).select("id", "op")
    assert "Exchange" not in plan(diff)
    assert values(diff) == values(cdc.snapshot_diff(old, new, ["id"]).select("id", "op"))
    fact = a.join(b.withColumnRenamed("v", "w").hint("merge"), "id").groupBy("id").agg(F.sum("w").alias("w"))
    assert "Exchange" not in plan(fact) and fact.count() == 800
    bucketed.drop_bucketed(spark, "t_old", "t_new")
    assert not spark.catalog.tableExists("t_old")


def test_rows_without_key_have_no_bucket(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (None,)], "id long")
    with pytest.raises(Exception, match="needs a value of id"):
        bucketed.write_bucketed(rows, "t_null", str(tmp_path / "n"), ["id"], 2)


# Cube increments


def test_cube_takes_each_batch_once(spark, tmp_path):
    root, dims = str(tmp_path / "cube"), ["a", "b"]
    rows = [(f"a{i % 3}" if i % 11 else None, f"b{i % 4}", i / 7, float(i % 5) if i % 6 else None, f"k{i % 40}") for i in range(300)]
    facts = spark.createDataFrame(rows, "a string, b string, p double, r double, k string")
    parts = [facts.where("p < 10"), facts.where("p BETWEEN 10 AND 30"), facts.where("p > 30")]
    for i, part in enumerate(parts):
        assert cube_store.add_to_cube(spark, part, root, f"d{i}", dims, "p", "r", "k")
        assert not cube_store.add_to_cube(spark, part, root, f"d{i}", dims, "p", "r", "k")
    got = cube_store.read_cube(spark, root, dims, "p", "r")
    assert values(got.drop("distinct_estimate")) == values(olap.cube_full(facts, dims, "p", "r"))
    assert got.where("grouping_id = 3").first()["distinct_estimate"] == pytest.approx(40, abs=2)


# Backfill


def test_backfill_lists_only_the_missing_days(spark, tmp_path):
    raw, curated = str(tmp_path / "raw"), str(tmp_path / "curated")
    days = spark.range(300).select("id", F.date_add(F.lit("2024-01-01"), (F.col("id") % 30).cast("int")).alias("day"))
    sinks.overwrite_partitions(days, raw, ["day"])
    sinks.overwrite_partitions(days.where("day NOT IN (DATE '2024-01-05', DATE '2024-01-20')"), curated, ["day"])
    seen = []

    def process(df):
        text = plan(df)
        seen.append((df.count(), "PartitionFilters: [isnotnull(day" in text or "PartitionFilters: [day" in text))
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        files = [leaves.apply(i).metrics().get("numPartitions") for i in range(leaves.size())]
        seen.append([m.get().value() for m in files if m.isDefined()])
        return df

    source = spark.read.parquet(raw)
    assert recovery.backfill_partitions(spark, source, curated, "day", process, "2024-01-01", "2024-01-30") == ["2024-01-05", "2024-01-20"]
    assert seen[0] == (20, True) and seen[1] in ([2], [])
    assert spark.read.parquet(curated).count() == 300
    assert recovery.backfill_partitions(spark, source, curated, "day", process, "2024-01-01", "2024-01-30") == []


# Stream state


def land(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(dict(zip(("id", "ts", "user", "v"), r))) + "\n" for r in rows))


SCHEMA = "id long, ts timestamp, user string, v double"


def read(spark, path):
    return jobs.read_messages(spark, str(path), T.StructType.fromDDL(SCHEMA), "json", files_per_batch=1)


def run_state(spark, tmp_path, **options):
    changes = state.last_rows(read(spark, tmp_path / "in"), ["user"], ["ts", "id"], ["v"], **options)
    query = state.write_changes(changes, str(tmp_path / "out"), str(tmp_path / "mark")).start()
    query.awaitTermination()
    return query


def test_late_rows_do_not_undo_newer_ones(spark, tmp_path):
    land(tmp_path / "in", "1.json", [(1, "2024-01-01T00:00:00Z", "a", 1.0), (2, "2024-01-01T02:00:00Z", "b", 2.0)])
    run_state(spark, tmp_path)
    land(tmp_path / "in", "2.json", [(3, "2024-01-01T01:00:00Z", "b", 3.0), (4, "2024-01-01T01:00:00Z", "a", 4.0), (5, "2024-01-01T01:00:00Z", "a", None)])
    run_state(spark, tmp_path)
    last = state.read_last(spark, str(tmp_path / "out"), ["user"], ["ts", "id"])
    assert values(last, "user", "id", "v") == [("a", 5, None), ("b", 2, 2.0)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3  # b was not written again
    state.compact(spark, str(tmp_path / "out"), ["user"], ["ts", "id"], str(tmp_path / "whole"))
    assert spark.read.parquet(str(tmp_path / "whole")).count() == 2


def test_idle_keys_leave_the_store(spark, tmp_path):
    land(tmp_path / "in", "1.json", [(1, "2024-01-01T00:00:00Z", "a", 1.0)])
    land(tmp_path / "in", "2.json", [(2, "2024-01-20T00:00:00Z", "b", 2.0)])
    land(tmp_path / "in", "3.json", [(3, "2024-01-21T00:00:00Z", "b", 3.0)])
    query = run_state(spark, tmp_path, delay="1 hour", idle="2 days")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    last = state.read_last(spark, str(tmp_path / "out"), ["user"], ["ts", "id"])
    assert values(last, "user", "v") == [("a", 1.0), ("b", 3.0)]


def test_failed_batch_is_run_again_once(spark, tmp_path):
    land(tmp_path / "in", "1.json", [(1, "2024-01-01T00:00:00Z", "a", 1.0)])
    land(tmp_path / "in", "2.json", [(2, "2024-01-01T00:00:00Z", "a", 1.0)])
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def stop(batch_id):
        if batch_id == 1:
            raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        jobs.drain(jobs.write_batches(read(spark, tmp_path / "in"), out, mark, after=stop))
    land(tmp_path / "in", "3.json", [(3, "2024-01-01T00:00:00Z", "a", 1.0)])
    for _ in range(2):
        jobs.drain(jobs.write_batches(read(spark, tmp_path / "in"), out, mark))
    assert values(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


# The run log


def test_run_that_fails_after_the_load_is_no_success(spark, tmp_path, monkeypatch):
    raw = catalog_raw(spark, "/root/testdata/sf0.001") if __import__("os").path.isdir("/root/testdata/sf0.001") else pytest.skip("no tables")
    monkeypatch.setattr("folioforge.plans.pipeline.validate_report", lambda df: (_ for _ in ()).throw(RuntimeError("audit")))
    root = str(tmp_path / "run")
    with pytest.raises(RuntimeError, match="audit"):
        run_catalog_pipeline(spark, raw, root, "2024-01-01T00:00:00")
    assert [r["status"] for r in read_runs(spark, f"{root}/etl_log", ETL_EXECUTION_LOG).collect()] == ["FAILED"]
