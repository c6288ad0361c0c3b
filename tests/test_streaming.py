import json

import pytest
from helpers import values
from pyspark.sql import functions as F

from folioforge.sources import sinks
from folioforge.streaming import jobs

pytestmark = pytest.mark.mock
SCHEMA = "id long, ts timestamp, user string, v double"


def feed(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(dict(zip(("id", "ts", "user", "v"), r))) + "\n" for r in rows))


def stream(spark, path, **options):
    from pyspark.sql import types as T

    return jobs.read_messages(spark, str(path), T.StructType.fromDDL(SCHEMA), "json", **options)


def test_resume_reads_each_message_once(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    feed(source, "1.json", [(1, "2024-01-01T00:00:00Z", "a", 1.0)])
    jobs.drain(jobs.write_append(stream(spark, source), out, mark))
    feed(source, "2.json", [(2, "2024-01-01T00:01:00Z", "a", 2.0)])
    for _ in range(2):
        jobs.drain(jobs.write_append(stream(spark, source), out, mark))
    assert values(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_replays_are_dropped_across_batches(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    feed(source, "1.json", [(1, "2024-01-01T00:00:00Z", "a", 1.0), (1, "2024-01-01T00:00:00Z", "a", 1.0)])
    feed(source, "2.json", [(1, "2024-01-01T00:00:00Z", "a", 1.0), (2, "2024-01-01T00:00:05Z", "a", 1.0)])
    jobs.drain(jobs.write_append(jobs.dedup(stream(spark, source, files_per_batch=1), ["id"]), out, mark))
    assert values(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_late_messages_miss_closed_windows(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    feed(source, "1.json", [(1, "2024-01-01T00:00:10Z", "a", 1.0), (2, "2024-01-01T01:00:00Z", "a", 1.0)])
    jobs.drain(jobs.write_append(jobs.throughput(stream(spark, source), ["user"]), out, mark))
    feed(source, "2.json", [(3, "2024-01-01T00:00:20Z", "a", 1.0), (4, "2024-01-01T02:00:00Z", "a", 1.0)])
    jobs.drain(jobs.write_append(jobs.throughput(stream(spark, source), ["user"]), out, mark))
    assert values(spark.read.parquet(out).select(F.date_format("window_start", "HH:mm").alias("w"), "user", "n")) == [("00:00", "a", 1), ("01:00", "a", 1)]


def test_session_windows(spark, tmp_path):
    source = tmp_path / "in"
    feed(source, "1.json", [(1, "2024-01-01T00:00:00Z", "a", 1.0), (2, "2024-01-01T00:04:00Z", "a", 1.0), (3, "2024-01-01T00:20:00Z", "a", 1.0), (9, "2024-01-02T00:00:00Z", "z", 1.0)])
    counted = jobs.throughput(stream(spark, source), ["user"], session_gap="5 minutes")
    jobs.drain(jobs.write_append(counted, str(tmp_path / "out"), str(tmp_path / "mark")))
    assert values(spark.read.parquet(str(tmp_path / "out")), "user", "n") == [("a", 1), ("a", 2)]


def test_upsert_stream_keeps_newest_and_routes_bad(spark, tmp_path):
    source, out, dead = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "dead")

    def run(mark):
        writer = jobs.upsert_stream(stream(spark, source, files_per_batch=1), out, str(tmp_path / mark), ["user"], ["ts", "id"],
                                    good=F.col("v") >= 0, dead_letters=dead, buckets=4)
        jobs.drain(writer)

    feed(source, "1.json", [(1, "2024-01-01T00:02:00Z", "a", 1.0), (2, "2024-01-01T00:01:00Z", "b", 2.0)])
    feed(source, "2.json", [(3, "2024-01-01T00:01:00Z", "a", 9.0), (4, "2024-01-01T00:05:00Z", "b", 4.0), (5, "2024-01-01T00:09:00Z", "c", -1.0), (6, "2024-01-01T00:09:00Z", "d", None)])
    run("mark")
    expected = [("a", 1.0), ("b", 4.0)]
    assert values(sinks.read_buckets(spark, out), "user", "v") == expected
    assert values(spark.read.parquet(dead), "user") == [("c",), ("d",)]
    # A lost checkpoint replays every batch; the target and the dead letters stay the same.
    run("mark2")
    assert values(sinks.read_buckets(spark, out), "user", "v") == expected
    assert spark.read.parquet(dead).count() == 2


def test_parse_marks_bad_text(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": "x"}',), ("oops",), (None,)], "body string")
    assert [r[0] for r in jobs.parse(df, "body", "k bigint").select("message.k").collect()] == [1, None, None, None]
    assert [r[0] for r in jobs.parse(df, "body", "k bigint").select(F.col("message").isNotNull()).collect()] == [True, False, False, False]


def test_operations_filter(spark):
    df = spark.createDataFrame([("insert", 1), ("update", 2), ("noise", 3)], "op string, k int")
    assert values(jobs.operations(df, "op", ["insert", "update"], ["k"])) == [("insert", 1), ("update", 2)]
