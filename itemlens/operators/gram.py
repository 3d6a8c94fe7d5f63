"""Least squares from one aggregation (M6, M14): means and covariances of all features and the label, solved in closed form.

The aggregation returns (d + 1)(d + 2) / 2 covariances for d features, combined partially on the map side, so the driver
sees one row however many rows are fitted. Covariances are accumulated around the running mean, which keeps columns of very
different size apart. A feature without variance, or one that the others determine, gets the coefficients of least norm.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemlens.operators.evaluate import regression_metrics
from itemlens.operators.split import hash_split


@dataclass(frozen=True)
class Line:
    """A fitted linear model."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    n: int

    def predict(self) -> Column:
        """The prediction as an expression over the feature columns."""
        out = F.lit(self.intercept)
        for name, c in zip(self.features, self.coefficients):
            out = out + F.lit(c) * F.col(name)
        return out


def covariances(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``n``, the means ``m0, m1, ...`` and the population covariances ``c0_0, c0_1, ...`` of ``columns``."""
    aggs = [F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(columns))]
    for i, j in combinations_with_replacement(range(len(columns)), 2):
        aggs.append(F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}"))
    return df.agg(*aggs)


def fit(df: DataFrame, features: list[str], label: str) -> Line:
    """Ordinary least squares of ``label`` on ``features``; rows with a null in any of them don't count."""
    columns = [*features, label]
    row = covariances(df.dropna(subset=columns).select(*(F.col(c).cast("double").alias(c) for c in columns)), columns).first()
    d = len(features)
    if not row["n"]:
        return Line(tuple(features), (0.0,) * d, 0.0, 0)
    moments = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(d + 1)] for i in range(d + 1)])
    # Features are scaled to unit variance before solving; their sizes may be many orders of magnitude apart.
    scale = np.sqrt(np.diag(moments)[:d])
    scale[scale == 0] = 1.0
    solved, *_ = np.linalg.lstsq(moments[:d, :d] / np.outer(scale, scale), moments[:d, d] / scale, rcond=1e-12)
    coefficients = solved / scale
    means = np.array([row[f"m{i}"] for i in range(d + 1)])
    return Line(tuple(features), tuple(map(float, coefficients)), float(means[d] - coefficients @ means[:d]), row["n"])


def train(df: DataFrame, features: list[str], label: str, key_cols: list[str]) -> tuple[Line, DataFrame]:
    """M14 in closed form: split by key hash, fit, and the metrics of the held-out side."""
    data = df.dropna(subset=[label, *features])
    train_side, test_side = hash_split(data, key_cols)
    line = fit(train_side, features, label)
    return line, regression_metrics(test_side.withColumn("prediction", line.predict()), label=label)
