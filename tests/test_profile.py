import math

import numpy as np
import pandas as pd
import pytest
from helpers import values
from pyspark.sql import functions as F

from folioforge.operators import aggregates, profile, scaling
from folioforge.operators.quantiles import exact_quantiles

pytestmark = pytest.mark.unit
PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize(
    "data",
    [
        [5.0],
        [1.0, 2.0],
        [3.0] * 50 + [1.0, 2.0, 9.0],
        list(np.random.default_rng(1).normal(size=3000)),
        list(np.random.default_rng(2).integers(0, 5, 2000).astype(float)),
        [0.0] * 1500 + list(np.random.default_rng(3).exponential(size=1500)),
    ],
)
@pytest.mark.parametrize("accuracy", [10, 50_000])
def test_quantiles_are_exact_whatever_the_sketch_says(spark, data, accuracy):
    df = spark.createDataFrame([(float(v),) for v in data], "v double").repartition(5)
    row = exact_quantiles(df, ["v"], PROBS, accuracy=accuracy).first()
    assert row["n"] == len(data)
    np.testing.assert_allclose(row["q"], np.quantile(data, PROBS), rtol=1e-12, atol=1e-12)


def test_quantiles_skip_nulls_nan_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (3.0, None)], "a double, b double")
    assert values(exact_quantiles(df, ["a", "b"], [0.5]), "column_name", "q") == [("a", [2.0])]


def test_group_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"g": np.where(rng.random(4000) < 0.6, "hot", rng.integers(0, 40, 4000).astype(str)), "v": rng.normal(size=4000).round(1)})
    df = spark.createDataFrame(frame).repartition(7)
    for accuracy in (5, 2000):
        got = {r["g"]: r["q"] for r in exact_quantiles(df, ["v"], [0.25, 0.5], keys=["g"], accuracy=accuracy).collect()}
        expected = frame.groupby("g")["v"].quantile([0.25, 0.5]).unstack()
        assert set(got) == set(expected.index)
        for g, q in got.items():
            np.testing.assert_allclose(q, expected.loc[g].to_numpy(), atol=1e-12)


def test_quantiles_do_not_collect_the_column(spark):
    df = spark.range(10_000).select(F.rand(7).alias("v"))
    plan = exact_quantiles(df, ["v"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan


@pytest.mark.parametrize("data", [[1.0], [1.0, 4.0], [1.0, 2.0, 6.0], [1.0, 2.0, 2.0, 5.0, 9.0]])
def test_moments_match_pandas(spark, data):
    s = pd.Series(data)
    table = profile.numeric_profile(spark.createDataFrame([(v,) for v in data], "v double"), ["v"], digits=4)
    row = table.first()
    assert row["n"] == len(data)
    assert row["mean"] == pytest.approx(s.mean(), abs=1e-4)
    assert row["skew"] == pytest.approx(s.skew() if len(data) > 2 else 0, abs=1e-4)
    if len(data) == 3:
        assert row["kurt"] is None
    else:
        assert row["kurt"] == pytest.approx(s.kurtosis() if len(data) > 2 else 0, abs=1e-4)
    assert row["std"] is None if len(data) == 1 else row["std"] == pytest.approx(s.std(), abs=1e-4)
    assert profile.describe_exact(table).columns[1] == "n"


@pytest.mark.parametrize("data, bins", [([1.0, 2.0, 2.0, 5.0, 9.0], 4), ([3.0, 3.0], 4), ([0.0, 10.0], 5), ([1.0, None, 2.0], 3)])
def test_histogram_matches_numpy(spark, data, bins):
    counts, edges = np.histogram([v for v in data if v is not None], bins=bins)
    rows = profile.histogram(spark.createDataFrame([(v,) for v in data], "v double"), "v", bins).orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(counts)
    assert [r["centre"] for r in rows] == pytest.approx([(a + b) / 2 for a, b in zip(edges, edges[1:])], abs=0.006)


def test_correlation(spark):
    frame = pd.DataFrame({"a": [1.0, 2, 3, 4], "b": [2.0, 1, None, 5], "c": [7.0] * 4})
    df = spark.createDataFrame([tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in frame.to_numpy().tolist()], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == got[("b", "a")] == round(frame["a"].corr(frame["b"]), 2)
    assert got[("a", "a")] == 1.0 and got[("c", "a")] is None and len(got) == 9


def test_outliers_and_capping(spark):
    df = spark.createDataFrame([(float(v), 5.0) for v in [*range(1, 20), 500]], "v double, k double")
    got = {r["column_name"]: (r["outliers"], r["pct"], r["severity"]) for r in profile.iqr_outliers(df, ["v", "k"]).collect()}
    assert got == {"v": (1, 5.0, "Moderate"), "k": (0, 0.0, "Normal")}
    capped = profile.iqr_cap(df, ["v"]).agg(F.max("v")).first()[0]
    q1, q3 = np.quantile([*range(1, 20), 500], [0.25, 0.75])
    assert capped == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_scaling_of_constant_and_missing(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, k double")
    assert values(scaling.minmax_scale(df, ["a", "k"]), "scaled_a", "scaled_k") == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]
    assert values(scaling.zscore_scale(df, ["a", "k"]), "z_a", "z_k") == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 1))
    data = np.hstack([base + 0.1 * rng.normal(size=(400, 1)), base * -2 + 0.3 * rng.normal(size=(400, 1)), rng.normal(size=(400, 3))])
    df = spark.createDataFrame(pd.DataFrame(data, columns=list("abcde")).assign(key=range(400)))
    variance, points = scaling.pca(df, list("abcde"), k=2)
    z = (data - data.mean(0)) / data.std(0)
    values_, vectors = np.linalg.eigh(np.cov(z.T, bias=True))
    order = np.argsort(values_)[::-1]
    assert [r["variance_pct"] for r in variance.orderBy("component").collect()] == pytest.approx((values_[order] / values_.sum() * 100)[:2], abs=0.06)
    first = vectors[:, order[0]]
    first = first if first[np.argmax(np.abs(first))] > 0 else -first
    got = np.array([r["pc1"] for r in points.orderBy("key").collect()])
    np.testing.assert_allclose(got, z @ first, atol=2e-3)
    assert scaling.total_variance(scaling.pca(df, list("abcde"), k=5)[0]).first()[0] == pytest.approx(100, abs=0.3)
    few, none = scaling.pca(df.limit(5), list("abcde"))
    assert few.isEmpty() and none.isEmpty() and none.columns == points.columns
    as_array, other = scaling.pca(df.select("key", F.array(*"abcde").alias("e")), "e", k=2)
    assert values(as_array) == values(variance) and values(other, "key", "pc1", "pc2") == values(points, "key", "pc1", "pc2")


def test_column_types(spark):
    df = spark.createDataFrame([(1, 2.0, "x", True)], "a int, b double, c string, d boolean")
    assert [k for _, _, k in profile.column_types(df)] == ["numeric", "numeric", "categorical", "categorical"]
    assert profile.numeric_columns(df) == ["a", "b"]


def test_null_profile_of_empty_frame(spark):
    empty = spark.createDataFrame([], "a int")
    assert values(profile.null_profile(empty)) == [("a", 0, 0.0)]
    assert values(profile.null_totals(empty)) == [(0, 1, 0, 0.0)]


def test_entity_relative_keeps_rows_without_entity(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), (None, "x", 8.0), ("b", None, 2.0)], "e string, g string, v double")
    out = values(aggregates.entity_relative(df, "e", "v", "g"), "e", "g", "v", "entity_count", "entity_avg", "diff_from_group_median")
    assert out == sorted([("a", "x", 1.0, 2, 2.0, -2.0), ("a", "x", 3.0, 2, 2.0, 0.0), (None, "x", 8.0, None, None, 5.0), ("b", None, 2.0, 1, 2.0, None)], key=repr)


def test_sample_is_stable_under_repartition(spark):
    df = spark.range(500)
    for seed in (None, "42"):
        assert values(aggregates.sample_rows(df, "id", 12, seed)) == values(aggregates.sample_rows(df.repartition(9), "id", 12, seed))
    assert values(aggregates.sample_rows(df, "id", 12)) != values(aggregates.sample_rows(df, "id", 12, "42"))


def test_distinct_counts(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), F.lit(None).cast("string").alias("b"))
    assert values(profile.distinct_counts(df, ["a", "b"])) == [("a", 7)]
    assert values(profile.distinct_counts(df, ["a", "b"], approx=True)) == [("a", 7), ("b", 0)]


def test_approx_quantiles(spark):
    row = exact_quantiles(spark.range(1001).select(F.col("id").alias("v")), ["v"], [0.5], approx=True).first()
    assert row["q"][0] == pytest.approx(500, abs=2)
