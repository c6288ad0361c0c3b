"""Scaling and principal components."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame, functions as F

from folioforge.functions.rounding import stable_round


def minmax_scale(df: DataFrame, columns: Sequence[str], prefix: str = "scaled_") -> DataFrame:
    """Columns mapped to [0, 1]; a constant column becomes 0, null stays null."""
    span = df.agg(
        *[F.min(c).cast("double").alias(f"_lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"_hi_{c}") for c in columns],
    )
    scaled = df.crossJoin(F.broadcast(span)).withColumns(
        {
            f"{prefix}{c}": F.when(F.col(f"_hi_{c}") == F.col(f"_lo_{c}"), F.col(c) * 0.0).otherwise(
                (F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))
            )
            for c in columns
        }
    )
    return scaled.drop(*[f"_{side}_{c}" for c in columns for side in ("lo", "hi")])


def zscore_scale(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Columns with mean 0 and population deviation 1; a constant column becomes 0."""
    stats = df.agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_sd_{c}") for c in columns],
    )
    scaled = df.crossJoin(F.broadcast(stats)).withColumns(
        {
            f"{prefix}{c}": F.when(F.col(f"_sd_{c}") == 0, F.col(c) * 0.0).otherwise(
                (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_sd_{c}")
            )
            for c in columns
        }
    )
    return scaled.drop(*[f"_{stat}_{c}" for c in columns for stat in ("mean", "sd")])


def pca(df: DataFrame, features: Sequence[str] | str, k: int = 2, min_rows: int = 10) -> tuple[DataFrame, DataFrame]:
    """(variance, projected) of the first ``k`` components of features with mean 0 and population deviation 1.

    ``features`` is a list of numeric columns or one array column. Rows with a gap are left out, and every other column is
    carried along, so labels stay with their points. The sign of a component is fixed by making its largest loading
    positive. Fewer than ``min_rows`` rows give empty frames. Only statistics of the features reach the driver; for
    columns they come from one aggregate, and the projection is a column expression.
    """
    if isinstance(features, str):
        rows, shares, scores = _array_components(df, features, k, min_rows)
    else:
        rows, shares, scores = _column_components(df, list(features), k, min_rows)
    listed = [(j + 1, share * 100) for j, share in enumerate(shares)]
    variance = df.sparkSession.createDataFrame(listed, "component int, variance double").select(
        "component", stable_round(F.col("variance"), 1).alias("variance_pct")
    )
    points = rows.select(*df.columns, *[stable_round(s, 3).alias(f"pc{j + 1}") for j, s in enumerate(scores)])
    return variance, points


def total_variance(variance: DataFrame) -> DataFrame:
    """One row: the share that the listed components explain together."""
    return variance.agg(stable_round(F.sum("variance_pct"), 1).alias("total_variance_pct"))


def _sign(loadings: Sequence[float]) -> float:
    top = max(map(abs, loadings))
    return 1.0 if next(x for x in loadings if abs(x) >= top * (1 - 1e-9)) >= 0 else -1.0  # the first of equals


def _column_components(df: DataFrame, features: list[str], k: int, min_rows: int):
    ready = df.dropna(subset=features)
    pairs = [(i, j) for i in range(len(features)) for j in range(i, len(features))]
    values = [F.col(c).cast("double") for c in features]
    stats = ready.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
        *[F.covar_pop(values[i], values[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if stats["n"] < min_rows:
        return ready.limit(0), [], [F.lit(0.0)] * k
    spread = [max(0.0, stats[f"c{i}_{i}"]) ** 0.5 for i in range(len(features))]
    matrix = np.zeros((len(features), len(features)))
    for i, j in pairs:
        scale = spread[i] * spread[j]
        matrix[i, j] = matrix[j, i] = stats[f"c{i}_{j}"] / scale if scale else 0.0
    shares, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-shares, kind="stable")[:k]
    scores = []
    for j in order:
        loadings = [float(x) for x in vectors[:, j]]
        score = F.lit(0.0)
        for i, loading in enumerate(loadings):
            if spread[i]:
                score = score + (values[i] - stats[f"m{i}"]) * (loading * _sign(loadings) / spread[i])
        scores.append(score)
    return ready, [float(shares[j] / max(shares.sum(), 1e-300)) for j in order], scores


def _array_components(df: DataFrame, column: str, k: int, min_rows: int):
    ready = df.where(F.col(column).isNotNull()).withColumn("_raw", array_to_vector(column))
    n = ready.count()
    if n < min_rows:
        return ready.limit(0), [], [F.lit(0.0)] * k
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(ready)
    scaled = scaler.transform(ready)
    model = PCA(k=k, inputCol="_scaled", outputCol="_pc").fit(scaled)
    population = (n / (n - 1)) ** 0.5  # the scaler divides by the deviation of a sample
    loadings: DenseMatrix = model.pc
    signs = [_sign([loadings[i, j] for i in range(loadings.numRows)]) for j in range(k)]
    rows = model.transform(scaled).withColumn("_s", vector_to_array("_pc"))
    return rows, [float(v) for v in model.explainedVariance], [F.get("_s", F.lit(j)) * s * population for j, s in enumerate(signs)]
