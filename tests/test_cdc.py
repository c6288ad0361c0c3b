import pytest
from helpers import values
from hypothesis import HealthCheck, given, settings, strategies as st

from folioforge.operators import cdc
from folioforge.plans.recovery import dataset_checksum

pytestmark = pytest.mark.unit
SCHEMA = "k string, a int, b double"
snapshot = st.dictionaries(st.sampled_from("pqrstuv"), st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from([0.5, 1.5])), max_size=7)


def frame(spark, data):
    return spark.createDataFrame([(k, a, b) for k, (a, b) in data.items()], SCHEMA)


@given(old=snapshot, new=snapshot)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_diff_then_apply_gives_the_new_snapshot(spark, old, new):
    before, after = frame(spark, old), frame(spark, new)
    row = cdc.cdc_summary(before, after, ["k"]).first()
    common = set(old) & set(new)
    assert (row["inserted"], row["deleted"]) == (len(set(new) - set(old)), len(set(old) - set(new)))
    assert (row["updated"], row["unchanged"]) == (sum(old[k] != new[k] for k in common), sum(old[k] == new[k] for k in common))
    assert values(cdc.apply_feed(before, cdc.cdc_feed(before, after, ["k"]), ["k"]), "k", "a", "b") == values(after)
    merged = cdc.upsert(before, after, ["k"])
    assert values(merged, "k", "a", "b") == values(frame(spark, {**old, **new}))
    assert values(cdc.upsert(merged, after, ["k"]), "k", "a", "b") == values(merged, "k", "a", "b")


def test_null_changes_and_extra_columns(spark):
    old = spark.createDataFrame([("p", None, 1.0), ("q", 1, 1.0), ("r", None, 1.0), (None, 1, 1.0)], SCHEMA)
    new = spark.createDataFrame([("p", None, 1.0, "x"), ("q", None, 1.0, "x"), ("r", 3, 1.0, "x")], SCHEMA + ", extra string")
    row = cdc.cdc_summary(old, new, ["k"]).first()
    assert (row["unchanged"], row["updated"], row["inserted"], row["deleted"]) == (1, 2, 0, 1)
    assert values(cdc.cdc_column_audit(old, new, ["k"])) == [
        ("q", "UPDATE", "a", "1", None), ("r", "UPDATE", "a", None, "3"), (None, "DELETE", "a", "1", None), (None, "DELETE", "b", "1.00", None)
    ]


def test_missing_keys_and_unlike_types(spark):
    old = spark.createDataFrame([("p", 1, 1.0), (None, 1, 1.0), ("s", 5, 2.0), ("t", 5, 2.0)], SCHEMA)
    new = spark.createDataFrame([("u", 1, 1.0), (None, 2, 1.0)], SCHEMA)
    metrics = cdc.upsert_metrics(old, new, ["k"]).first()
    assert metrics["total_after"] == cdc.upsert(old, new, ["k"]).count() == 5
    assert (metrics["matched"], metrics["inserted"], metrics["modified"]) == (1, 1, 1)
    text = spark.createDataFrame([("p", "1"), ("s", "n/a")], "k string, a string")
    row = cdc.cdc_summary(old.where("k IN ('p', 's')"), text, ["k"]).first()
    assert (row["unchanged"], row["updated"]) == (1, 1)
    numbers = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    texts = spark.createDataFrame([("1", "x"), ("3", "y")], "k string, v string")
    assert cdc.cdc_summary(numbers, texts, ["k"]).first().asDict() == {"inserted": 1, "updated": 0, "deleted": 1, "unchanged": 1}


def test_audit_shows_every_compared_change(spark):
    old = spark.createDataFrame([("p", 1, 1.0), ("q", 1, 1.5), ("r", 1, 1e30)], SCHEMA)
    new = spark.createDataFrame([("p", 1, 1.0000001), ("q", 1, 1.5), ("r", 1, 2e30)], SCHEMA)
    assert cdc.cdc_summary(old, new, ["k"]).first()["updated"] == 2
    assert values(cdc.cdc_column_audit(old, new, ["k"])) == [("p", "UPDATE", "b", "1.00", "1.0000001"), ("r", "UPDATE", "b", "1.0E30", "2.0E30")]


def test_empty_snapshots(spark):
    empty, some = frame(spark, {}), frame(spark, {"p": (1, 0.5)})
    assert cdc.cdc_summary(empty, empty, ["k"]).first().asDict() == {"inserted": 0, "updated": 0, "deleted": 0, "unchanged": 0}
    assert values(cdc.upsert(empty, some, ["k"]), "k") == values(cdc.upsert(some, empty, ["k"]), "k") == [("p",)]
    assert cdc.upsert_metrics(empty, some, ["k"]).first()["inserted"] == 1
    assert values(cdc.cdc_samples(empty, some, ["k"])) == [("inserted", "p", "1", "0.50")]


def test_repeated_keys_do_not_multiply(spark):
    many = spark.createDataFrame([("p", i, 1.0) for i in range(50)], SCHEMA)
    assert cdc.cdc_summary(many, many, ["k"]).first().asDict() == {"inserted": 0, "updated": 0, "deleted": 0, "unchanged": 1}
    assert values(cdc.upsert(frame(spark, {}), many, ["k"], ["a"]), "k", "a") == [("p", 49)]
    assert values(cdc.cdc_key_sets(many, many, ["k"])) == [("common", 1), ("deleted", 0), ("inserted", 0)]


def test_last_event_decides(spark):
    target = frame(spark, {"p": (1, 1.0), "q": (1, 1.0)})
    feed = spark.createDataFrame([("p", "UPDATE", 5, 1.0, 1), ("p", "DELETE", None, None, 2), ("q", "DELETE", None, None, 1), ("q", "INSERT", 7, 2.0, 2)],
                                 "k string, op string, a int, b double, seq int")
    assert values(cdc.apply_feed(target, feed, ["k"], ["seq"])) == [("q", 7, 2.0)]


def test_checksum_ignores_order_and_sees_changes(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "\\N"), ("x", None)]
    df = spark.createDataFrame(rows, "s string, t string")
    base = values(dataset_checksum(df, ["s", "t"]))
    assert values(dataset_checksum(df.repartition(3).orderBy("t"), ["s", "t"])) == base
    swapped = spark.createDataFrame([("a", "b|c"), ("a", "b|c"), *rows[2:]], "s string, t string")
    assert values(dataset_checksum(swapped, ["s", "t"])) != base
    assert values(dataset_checksum(df.limit(0), ["s", "t"])) == [(0, "0")]
