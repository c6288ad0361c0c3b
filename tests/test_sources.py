import json
import struct
import zlib
from datetime import datetime, timezone

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from folioforge.plans import recovery, runlog
from folioforge.plans.catalog import prepare_catalog
from folioforge.plans.pipeline import run_catalog_pipeline, run_record_pipeline
from folioforge.plans.records import transform_records
from folioforge.schemas import ETL_EXECUTION_LOG, RAW_CATALOG
from folioforge.session import broadcast_if_small, cut_lineage, scratch_path, shared_dir
from folioforge.sources import buckets, catalog_csv, files, images, lookups, record_pages, sinks

pytestmark = pytest.mark.mock
HEADER = ",".join(RAW_CATALOG.names)


def write_csv(path, lines, raw=None):
    path.write_bytes(("\n".join([HEADER, *lines]) + "\n").encode() if raw is None else raw)
    return str(path)


def line(i, isbn, price="$5.00"):
    return f"name {i},4.5,dataset/Art/{i}.jpg,author,Paperback,Art,{price},,$,{isbn},x"


def test_csv_keeps_file_order_over_splits(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", [line(i, i % 50) for i in range(2000)])
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = catalog_csv.read_catalog_csv(spark, path)
        assert df.rdd.getNumPartitions() > 3
        kept = prepare_catalog(df)
        assert values(kept, "isbn", "title") == sorted(((str(i), f"name {i}") for i in range(50)), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)


def test_csv_bad_rows_bytes_and_empty(spark, tmp_path):
    good, extra = line(1, "a"), line(2, "b") + ",surplus,cells"
    broken = f"{HEADER}\n{good}\n{extra}\n".encode() + b"bad \xff byte" + line(3, "c")[6:].encode() + b"\n"
    df = cut_lineage(catalog_csv.read_catalog_csv(spark, write_csv(tmp_path / "b.csv", [], broken)))
    ok, corrupt = catalog_csv.split_corrupt(df)
    assert values(corrupt, "isbn") == [("b",)]
    assert "�" in ok.where("isbn = 'c'").first()["name"]
    with pytest.raises(catalog_csv.EmptySource):
        catalog_csv.read_catalog_csv(spark, write_csv(tmp_path / "e.csv", []))


def test_csv_columns_go_by_header_name(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "1.csv").write_text("isbn,extra,name\n1,x,One\n2,y,Two\n")
    df = catalog_csv.read_catalog_csv(spark, str(folder))
    assert values(df, "isbn", "name", "extra") == [("1", "One", "x"), ("2", "Two", "y")]
    (folder / "2.csv").write_text("name,extra,isbn\nThree,z,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        catalog_csv.read_catalog_csv(spark, str(folder)).collect()


def test_csv_without_schema_is_text(spark, tmp_path):
    (tmp_path / "s.csv").write_text("k,v\n1,2\n")
    df = catalog_csv.read_catalog_csv(spark, str(tmp_path / "s.csv"), schema=None, sequence=False)
    assert df.dtypes == [("k", "string"), ("v", "string")]


def test_pages_from_three_sources(spark, landed):
    pages, errors = record_pages.read_sources(spark, landed)
    docs = record_pages.explode_docs(pages)
    assert docs.count() == 12 and "_source" in docs.columns and not errors
    status = record_pages.source_status(spark, pages, list(landed), errors)
    assert {(r["records"], r["reported"], r["status"]) for r in status.collect()} == {(4, 4, "SUCCESS")}


def test_failing_sources_do_not_stop_others(spark, landed, tmp_path):
    (tmp_path / "bad.json").write_text("{not json\n")
    (tmp_path / "none.json").write_text(json.dumps({"numFound": 0, "docs": []}) + "\n")
    sources = {**landed, "absent": str(tmp_path / "absent"), "bad": str(tmp_path / "bad.json"), "none": str(tmp_path / "none.json")}
    pages, errors = record_pages.read_sources(spark, sources)
    status = record_pages.source_status(spark, cut_lineage(pages), list(sources), errors)
    got = {r["source"]: (r["records"], r["status"].split(":")[0]) for r in record_pages.require_records(status).collect()}
    assert got == {"science": (4, "SUCCESS"), "technology": (4, "SUCCESS"), "medicine": (4, "SUCCESS"), "absent": (0, "FAILED"), "bad": (0, "FAILED"), "none": (0, "FAILED")}
    nothing = record_pages.source_status(spark, None, ["absent"], {"absent": "gone"})
    with pytest.raises(catalog_csv.EmptySource):
        record_pages.require_records(nothing)


def test_pretty_printed_page(spark, tmp_path, payload):
    (tmp_path / "p.json").write_text(json.dumps(payload, indent=2))
    assert record_pages.explode_docs(record_pages.read_pages(spark, str(tmp_path / "p.json"), "s", multi_line=True)).count() == 4
    page = json.dumps(payload, indent=2)
    (tmp_path / "p.json").write_text(f"{page}\n{page}\n{{broken\n")
    pages = record_pages.read_pages(spark, str(tmp_path / "p.json"), "s", multi_line=True)
    assert record_pages.explode_docs(pages).count() == 8
    assert pages.where("_corrupt_record IS NOT NULL").count() == 1


@pytest.mark.parametrize("strategy", ["full", "incremental"])
def test_record_pipeline(spark, landed, tmp_path, strategy):
    root = str(tmp_path / "out")
    for n in (1, 2):
        run = run_record_pipeline(spark, landed, root, strategy, run_time=datetime(2024, 1, n, tzinfo=timezone.utc))
        assert run["status"] == "SUCCESS", run["error_msg"]
        # Identifiers repeat over the sources: 2 with an identifier, 6 without.
        assert (run["records_extracted"], run["records_after_transform"], run["records_loaded"]) == (12, 8, 8)
    runs = runlog.read_runs(spark, f"{root}/run_log")
    latest = runlog.latest_runs(runs, 1).first()
    assert runs.count() == 2 and latest["run_timestamp"].day == 2 and latest["load_strategy"] == strategy
    fact = sinks.read_published(spark, f"{root}/fact")
    assert fact.count() == 8
    assert runlog.freshness(fact, "2024-01-02 01:00:00").first()[0] == 3600
    metrics = runlog.run_metrics(runs).first()
    assert (metrics["runs"], metrics["success_rate"], metrics["error_rate"]) == (2, 100.0, 0.0)


def test_failed_runs_are_logged_and_leave_the_target(spark, landed, tmp_path):
    root = str(tmp_path / "out")
    run_record_pipeline(spark, landed, root, "full")
    before = values(sinks.read_published(spark, f"{root}/fact"), "ol_key")
    page = json.loads((tmp_path / "landing/science/page.json").read_text())
    page["docs"][2]["first_publish_year"] = 9999
    (tmp_path / "landing/science/page.json").write_text(json.dumps(page) + "\n")
    assert run_record_pipeline(spark, landed, root, "full")["error_msg"].startswith("GateFailed")
    assert run_record_pipeline(spark, {"x": str(tmp_path / "nowhere")}, root)["error_msg"].startswith("EmptySource")
    assert values(sinks.read_published(spark, f"{root}/fact"), "ol_key") == before
    assert values(runlog.read_runs(spark, f"{root}/run_log"), "status") == [("FAILED",), ("FAILED",), ("SUCCESS",)]
    with pytest.raises(ValueError):
        run_record_pipeline(spark, landed, root, "other")


def test_unreadable_source_is_retried_and_reported(spark, landed, tmp_path):
    (tmp_path / "broken.json.gz").write_bytes(b"not gzip at all")
    pauses = []
    sources = {**landed, "broken": str(tmp_path / "broken.json.gz")}
    run = run_record_pipeline(spark, sources, str(tmp_path / "out"), sleep=pauses.append)
    assert (run["status"], run["records_extracted"], pauses) == ("SUCCESS", 12, [2.0, 4.0, 8.0]), run["error_msg"]
    status = spark.read.parquet(str(tmp_path / "out/reports/*/sources"))
    assert values(status.where("source = 'broken'"), "records") == [(0,)]
    assert status.where("source = 'broken'").first()["status"].startswith("FAILED")


def test_routes_change_audit_and_buckets(spark, landed, tmp_path):
    root = str(tmp_path / "out")
    options = {
        "fail_rules": {"old": F.col("publish_year") > 1903},
        "warn_rules": {"no_identifier": F.col("isbn") != ""},
        "buckets": 4,
    }
    first = run_record_pipeline(spark, landed, root, **options)
    assert (first["status"], first["records_after_transform"], first["records_loaded"]) == ("SUCCESS", 8, 7), first["error_msg"]
    assert spark.read.parquet(f"{root}/quarantine").count() == 1 and spark.read.parquet(f"{root}/audit").count() == 6
    page = json.loads((tmp_path / "landing/science/page.json").read_text())
    page["docs"][2]["title"] = "Volume 3, revised"
    (tmp_path / "landing/science/page.json").write_text(json.dumps(page) + "\n")
    second = run_record_pipeline(spark, landed, root, **options)
    assert second["status"] == "SUCCESS" and sinks.read_buckets(spark, f"{root}/fact_buckets").count() == 7
    changes = values(spark.read.parquet(f"{root}/cdc_audit"), "key_id", "action", "column_changed", "old_value", "new_value")
    assert changes == [
        ("w003-science", "UPDATE", "title", "Volume 3", "Volume 3, revised"),
        ("w003-science", "UPDATE", "title_word_count", "2", "3"),
    ]
    assert run_record_pipeline(spark, landed, root, "full", buckets=4)["status"] == "FAILED"


def test_catalog_pipeline(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", [line(i, f"97800000000{i % 8:02d}") for i in range(12)])
    good, _ = catalog_csv.split_corrupt(cut_lineage(catalog_csv.read_catalog_csv(spark, path)))
    out = run_catalog_pipeline(spark, good, str(tmp_path / "out"), "2024-01-01T00:00:00")
    assert out["catalog"].count() == out["etl_fact"].count() == out["fact_book_sales"].count() == 8
    assert spark.read.option("header", True).csv(str(tmp_path / "out/processed")).count() == 8
    assert out["totals"].first()["failed"] == 0
    log = out["etl_log"].first()
    assert (log["extracted_records"], log["transformed_records"], log["loaded_records"], log["load_strategy"]) == (12, 8, 8, "FULL")
    again = run_catalog_pipeline(spark, good, str(tmp_path / "out"), "2024-01-02T00:00:00", strategy="incremental")
    assert again["etl_fact"].count() == 8 and again["etl_log"].count() == 2


def test_load_of_the_record_fact(spark, raw_records, tmp_path):
    fact = transform_records(raw_records)
    sinks.full_load(spark, fact, str(tmp_path / "t"))
    assert sinks.read_published(spark, str(tmp_path / "t")).count() == fact.count() == 5


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    assert sinks.read_published(spark, root, spark.range(1).schema).isEmpty()
    sinks.full_load(spark, spark.range(3), root)
    with pytest.raises(sinks.RejectedPublish):
        sinks.full_load(spark, spark.range(9), root, validate=lambda d: d.count() < 5)
    with pytest.raises(Exception):
        sinks.full_load(spark, spark.range(9).select(F.raise_error(F.lit("boom")).alias("id")), root)
    assert sinks.read_published(spark, root).count() == 3
    sinks.incremental_load(spark, spark.range(2, 6), root, ["id"])
    assert values(sinks.read_published(spark, root)) == [(i,) for i in range(6)]


def test_pointer_file(spark, tmp_path):
    path = str(tmp_path / "a/b")
    for text in ("one", "two"):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text


def test_bucket_upsert_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.range(400).select("id", F.lit(0).alias("v"), F.lit(5).alias("seq"))
    sinks.upsert_buckets(spark, rows, path, ["id"], buckets=16)
    placed = lambda: buckets.read_note(spark, path)[0]["placed"]
    before = placed()
    assert len(before) == 16 and len(set(before.values())) == 1
    batch = spark.createDataFrame([(7, 1, 9), (7, 2, 8)], "id long, v int, seq int")
    for _ in range(2):
        sinks.upsert_buckets(spark, batch, path, ["id"], buckets=16, order=["seq"])
    late = spark.createDataFrame([(7, 3, 1)], "id long, v int, seq int")
    sinks.upsert_buckets(spark, late, path, ["id"], buckets=16, order=["seq"], newest_wins=True)
    out = sinks.read_buckets(spark, path)
    assert out.count() == 400 and values(out.where("id = 7"), "v") == [(1,)]
    assert sum(placed()[b] != before[b] for b in before) == 1
    sinks.upsert_buckets(spark, late, path, ["id"], buckets=16, order=["seq"])
    assert values(sinks.read_buckets(spark, path).where("id = 7"), "v") == [(3,)]
    stored = [p for p in (tmp_path / "b" / "data").glob("version=*/bucket=*")]
    assert len(stored) == 17  # the state before the last batch stays readable


def test_failed_batch_leaves_no_bucket_behind(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.range(200).select("id", F.lit(0).alias("v"))
    sinks.upsert_buckets(spark, rows, path, ["id"], buckets=8)
    new = spark.range(300).select("id", F.lit(1).alias("v"))
    last = F.pmod(F.xxhash64("id"), F.lit(8)) == 7
    torn = new.withColumn("v", F.when(last, F.raise_error("disk full").cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="disk full"):
        sinks.upsert_buckets(spark, torn, path, ["id"])
    assert values(sinks.read_buckets(spark, path).groupBy("v").count()) == [(0, 200)]
    sinks.upsert_buckets(spark, new, path, ["id"])
    assert values(sinks.read_buckets(spark, path).groupBy("v").count()) == [(1, 300)]
    assert len(list((tmp_path / "b" / "data").iterdir())) == 2  # what the failed batch wrote is gone


def test_second_writer_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    rows = spark.range(50).select("id", F.lit(0).alias("v"))
    sinks.upsert_buckets(spark, rows, path, ["id"], buckets=4)
    plain, calls = buckets.new_version, []

    def racing():
        if not calls:
            calls.append(1)
            sinks.upsert_buckets(spark, rows.withColumn("v", F.lit(1)), path, ["id"])
        return plain()

    monkeypatch.setattr(buckets, "new_version", racing)
    with pytest.raises(buckets.ConcurrentUpdate):
        sinks.upsert_buckets(spark, rows.withColumn("v", F.lit(2)), path, ["id"])
    assert values(sinks.read_buckets(spark, path).groupBy("v").count()) == [(1, 50)]


def test_tables_are_published_together(spark, tmp_path):
    root = str(tmp_path / "w")
    tables = lambda n: {"dim": spark.range(n), "fact": spark.range(10 * n)}
    sinks.publish_tables(spark, tables(1), root)
    broken = {**tables(2), "fact": spark.range(20).select(F.raise_error("disk full").alias("id"))}
    with pytest.raises(Exception, match="disk full"):
        sinks.publish_tables(spark, broken, root)
    with pytest.raises(sinks.RejectedPublish):
        sinks.publish_tables(spark, tables(3), root, lambda t: t["fact"].count() < 30)
    assert {n: df.count() for n, df in sinks.read_tables(spark, root).items()} == {"dim": 1, "fact": 10}
    for n in (4, 5, 6):
        sinks.publish_tables(spark, tables(n), root)
    sinks.publish_tables(spark, {"dim": spark.range(7)}, root)
    assert {n: df.count() for n, df in sinks.read_tables(spark, root).items()} == {"dim": 7, "fact": 60}
    assert len(list((tmp_path / "w" / "tables" / "dim").iterdir())) == 2


def test_change_audit_meets_missing_keys(spark, tmp_path):
    rows = spark.createDataFrame([(None, "a"), ("k", "b")], "key string, v string")
    sinks.write_change_audit(spark, rows, rows, "key", str(tmp_path / "same"), "r", "2024-01-01")
    assert spark.read.parquet(str(tmp_path / "same")).isEmpty()
    new = spark.createDataFrame([(None, "c")], "key string, v string")
    sinks.write_change_audit(spark, rows, new, "key", str(tmp_path / "one"), "r", "2024-01-01")
    assert values(spark.read.parquet(str(tmp_path / "one")), "key_id", "action", "old_value", "new_value") == [(None, "UPDATE", "a", "c")]


def test_partition_overwrite_and_zones(spark, tmp_path):
    path, root = str(tmp_path / "p"), str(tmp_path / "z")
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string"), path, ["d"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, d string"), path, ["d"])
    assert values(spark.read.parquet(path), "v", "d") == [(1, "a"), (9, "b")]
    for _ in range(2):
        sinks.write_zone(spark.range(2), root, "staging", "r1", "s")
    sinks.write_zone(spark.range(1).withColumn("extra", F.lit(1)), root, "staging", "r2", "s")
    assert values(sinks.read_zone(spark, root, "staging"), "run_id", "id", "extra") == [("r1", 0, None), ("r1", 1, None), ("r2", 0, 1)]
    assert sinks.read_zone(spark, root, "staging", "r2").count() == 1
    with pytest.raises(ValueError):
        sinks.write_zone(spark.range(1), root, "gold", "r", "s")


def test_money_sink(spark):
    df = sinks.as_money(spark.createDataFrame([(1.005,), (1e12,)], "p double"), ["p"])
    assert [str(r[0]) for r in df.collect()] == ["1.01", "None"] and df.dtypes == [("p", "decimal(10,2)")]


def test_lookup_and_rates(spark):
    books = spark.createDataFrame([("9781509858637",), ("0000000000000",), ("9789999900000",), (None,)], "isbn string")
    more = lookups.publishers(spark).union(spark.createDataFrame([("97899999", None, None)], lookups.PUBLISHER_SCHEMA))
    out = {r["isbn"]: (r["publisher"], r["publisher_region"]) for r in lookups.enrich_publisher(books, more).collect()}
    assert out == {"9781509858637": ("Pan Macmillan", "UK"), "0000000000000": ("Independent Publisher", "Unknown"),
                   "9789999900000": ("Unknown Publisher", "Global"), None: ("Independent Publisher", "Unknown")}
    rates = spark.createDataFrame([("EUR", 0.5)], lookups.RATE_SCHEMA)
    row = lookups.add_converted(spark.createDataFrame([(10.0,)], "price double"), rates).first()
    assert (row["price_in_gbp"], row["price_in_eur"]) == (7.8, 5.0)


def test_lookup_documents(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"isbn_prefix": "12345678", "publisher": "P", "region": "R"}\n')
    assert values(lookups.publishers(spark, str(tmp_path / "p.json"))) == [("12345678", "P", "R")]


def png(path, pixels):
    height, width, _ = pixels.shape
    raw = b"".join(b"\x00" + pixels[y].tobytes() for y in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images(spark, tmp_path):
    root = tmp_path / "book-covers"
    pixels = np.random.default_rng(0).integers(0, 256, (4, 6, 3), dtype=np.uint8)
    png(root / "Art" / "1.png", pixels)
    png(root / "Art" / "2.png", np.full((2, 2, 3), 100, dtype=np.uint8))
    png(root / "Law" / "3.png", np.zeros((1, 3, 3), dtype=np.uint8))
    (root / "Law" / "4.jpg").write_bytes(b"no image")
    (root / "Law" / "notes.txt").write_text("x")
    found = images.image_files(spark, str(root))
    assert values(images.inventory(found)) == sorted([("Art", 2), ("Law", 2), (None, 4)], key=repr)

    catalog = spark.createDataFrame([(i, p) for i, p in enumerate(["dataset/Art/1.png", "dataset/Art/2.png", "dataset/Law/4.jpg", "dataset/Art/9.png", None])], "id int, img_paths string")
    covers = images.resolve_covers(catalog, found, "img_paths")
    assert values(covers, "id", "cover_url") == sorted([(0, "/covers/Art/1.png"), (1, "/covers/Art/2.png"), (2, "/covers/Law/4.jpg"), (3, None), (4, None)], key=repr)

    valid, rejected = images.attach_attributes(catalog, images.attributes(images.decode(spark, str(root))))
    rows = {r["id"]: r for r in valid.collect()}
    assert set(rows) == {0, 1} and rejected.first()[0] == 3
    grey = np.round(pixels.astype(float) @ np.array([0.299, 0.587, 0.114]))
    assert rows[0]["img_width"] == 6 and rows[0]["img_height"] == 4 and rows[0]["img_aspect_ratio"] == 1.5
    assert rows[0]["img_brightness"] == pytest.approx(grey.mean(), abs=0.1) and rows[0]["img_contrast"] == pytest.approx(grey.std(), abs=0.1)
    assert (rows[1]["img_brightness"], rows[1]["img_contrast"]) == (100.0, 0.0)


def test_retry(spark):
    calls, pauses = [], []

    def failing():
        calls.append(1)
        raise ConnectionError("down")

    with pytest.raises(ConnectionError):
        recovery.retry(failing, sleep=pauses.append)
    assert len(calls) == 4 and pauses == [2.0, 4.0, 8.0]
    calls.clear()
    pauses.clear()

    def throttled():
        calls.append(1)
        raise recovery.Throttled("429")

    with pytest.raises(recovery.Throttled):
        recovery.retry(throttled, sleep=pauses.append)
    assert len(calls) == 1 and pauses == []
    outcomes = iter([ConnectionError("x"), 7])

    def recovers():
        value = next(outcomes)
        if isinstance(value, Exception):
            raise value
        return value

    assert recovery.retry(recovers, factor=1, sleep=pauses.append) == 7 and pauses == [2.0]


def test_missing_days_and_backfill(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(date'2024-02-27', date'2024-03-02')) AS day").withColumn("v", F.lit(1))
    path = str(tmp_path / "d")
    sinks.overwrite_partitions(days.where(F.dayofmonth("day") != 29), path, ["day"])
    target = spark.read.parquet(path)
    assert [str(r[0]) for r in recovery.missing_partitions(target, F.col("day")).collect()] == ["2024-02-29"]
    recovery.backfill(days, target, path, "day", lambda d: d.withColumn("v", F.lit(2)), "2024-02-27", "2024-03-02")
    assert values(spark.read.parquet(path).groupBy("v").count()) == [(1, 4), (2, 1)]
    assert recovery.missing_partitions(days.limit(0), F.col("day"), "2024-01-01", "2024-01-03").count() == 3


def test_run_log_rejects_unknown_fields(spark, tmp_path):
    with pytest.raises(ValueError):
        runlog.append_run(spark, str(tmp_path), {"nope": 1})


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_broadcast_only_below_the_bound(spark, monkeypatch):
    small = broadcast_if_small(spark.range(10))
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr("folioforge.session.BROADCAST_ROWS", 5)
    assert "ResolvedHint" not in broadcast_if_small(spark.range(10))._jdf.queryExecution().analyzed().toString()


def test_bucket_count_and_columns_are_kept(spark, tmp_path):
    path = str(tmp_path / "b")
    rows = spark.range(100).select("id", F.lit("a").alias("v"))
    sinks.upsert_buckets(spark, rows, path, ["id"], buckets=8)
    sinks.upsert_buckets(spark, rows.withColumn("extra", F.lit(1)), path, ["id"], buckets=16)
    sinks.upsert_buckets(spark, rows.where("id < 10").withColumn("v", F.lit("b")), path, ["id"], buckets=3)
    out = sinks.read_buckets(spark, path)
    assert out.count() == out.select("id").distinct().count() == 100
    assert values(out.groupBy("v").agg(F.count("extra").alias("extra"), F.count("id").alias("n")), "v", "extra", "n") == [("a", 90, 90), ("b", 0, 10)]
    (tmp_path / "b" / "_layout").unlink()
    with pytest.raises(ValueError):
        sinks.upsert_buckets(spark, rows, path, ["id"])


def test_old_versions_go(spark, tmp_path):
    for i in range(4):
        sinks.full_load(spark, spark.range(i), str(tmp_path / "t"))
    assert len(list((tmp_path / "t" / "versions").iterdir())) == 2
    assert sinks.read_published(spark, str(tmp_path / "t")).count() == 3


def test_full_load_needs_all_sources(spark, landed, tmp_path):
    root = str(tmp_path / "out")
    run_record_pipeline(spark, landed, root, "full")
    run = run_record_pipeline(spark, {**landed, "gone": str(tmp_path / "gone")}, root, "full")
    assert run["status"] == "FAILED" and run["error_msg"].startswith("PartialSources")
    assert sinks.read_published(spark, f"{root}/fact").count() == 8


def test_failed_catalog_run_is_logged(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(Exception):
        run_catalog_pipeline(spark, spark.range(3), root, "2024-01-01T00:00:00")
    log = runlog.read_runs(spark, f"{root}/etl_log", ETL_EXECUTION_LOG).collect()
    assert [r["status"] for r in log] == ["FAILED"]
