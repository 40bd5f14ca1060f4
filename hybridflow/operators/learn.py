"""Logistic regression by mini-batch gradient steps, computed as distributed sums."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hybridflow.functions.vectors import log_loss, misclassified, predict

# Default number of features, quality threshold and sampling rate.
N_FEATURES = 100
THRESHOLD = 1.0
SAMPLING_RATE = 1.0

METRICS = {"log_loss": log_loss, "misclassified": misclassified}


@dataclass(frozen=True)
class Gradient:
    """Mean gradient and mean error over ``n`` usable rows; without any there is neither.

    ``n_invalid`` rows were set aside.
    """

    n: int
    error: float | None
    values: list[float] | None
    n_invalid: int = 0


def usable(size: int, label: str = "label", features: str = "features") -> Column:
    """Whether a row can teach: a finite label, and ``size`` finite features."""
    y, x = F.col(label).cast("double"), F.col(features)

    def finite(v):
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))

    return F.coalesce(finite(y) & (F.size(x) == size) & F.forall(x, finite), F.lit(False))


def score(rows: DataFrame, weights: list[float], features: str = "features") -> DataFrame:
    """Add ``p``, the probability of the positive class. Works on streams."""
    return rows.withColumn("p", predict(F.col(features), weights))


def error_rate(rows: DataFrame, weights: list[float], metric: str = "log_loss") -> DataFrame:
    """Mean error of the model on the usable rows, as one row."""
    return error_rates(rows, weights, [metric]).select(F.col(metric).alias("error_rate"), "n", "n_invalid")


def error_rates(rows: DataFrame, weights: list[float], metrics: list[str]) -> DataFrame:
    """Mean errors by several metrics in one scan, over the ``n`` usable rows."""
    fine = usable(len(weights))
    scored = score(rows.withColumn("features", F.when(fine, F.col("features"))), weights)
    losses = [F.avg(F.when(F.col("p").isNotNull(), METRICS[m](F.col("p"), F.col("label")))).alias(m) for m in metrics]
    return scored.agg(*losses, F.count("p").alias("n"), F.count_if(F.col("p").isNull()).alias("n_invalid"))


def gradient_sums(rows: DataFrame, weights: list[float], metric: str = "log_loss") -> DataFrame:
    """One row with ``n``, summed error, the summed gradient vector of the loss, and ``n_invalid``.

    Rows are summed where they are read, a matrix product per Arrow batch; only a vector
    per task is shuffled.
    """
    size = len(weights)
    w = np.asarray(weights, dtype=float)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, error, total, bad = 0, 0.0, np.zeros(size), 0
        for batch in batches:
            bad += batch.column(0).null_count
            batch = batch.filter(batch.column(0).is_valid())
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            p = 1.0 / (1.0 + np.exp(-(x @ w)))
            if metric == "log_loss":
                safe = np.clip(p, 1e-15, 1.0 - 1e-15)
                error -= float(np.sum(y * np.log(safe) + (1.0 - y) * np.log1p(-safe)))
            else:
                error += float(np.sum((p >= 0.5) != (y >= 0.5)))
            total += (p - y) @ x
            n += len(y)
        if n or bad:
            yield pa.RecordBatch.from_pydict({"n": [n], "error": [error], "g": [total.tolist()], "n_invalid": [bad]})

    # Rows that cannot teach go on as nulls, so that the same scan counts them.
    fine = usable(size)
    given = rows.select(
        F.when(fine, F.col("label").cast("double")).alias("label"), F.when(fine, F.col("features")).alias("features")
    )
    parts = given.mapInArrow(partial, "n BIGINT, error DOUBLE, g ARRAY<DOUBLE>, n_invalid BIGINT")
    # A vector sum of no rows is an error, so there is always this one.
    nothing = rows.sparkSession.range(0, 1, 1, 1).select(
        F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("error"),
        F.array_repeat(F.lit(0.0), size).alias("g"), F.lit(0).cast("bigint").alias("n_invalid"),
    )
    return parts.unionByName(nothing).agg(
        F.sum("n").alias("n"),
        F.sum("error").alias("error"),
        Summarizer.sum(array_to_vector(F.col("g"))).alias("g"),
        F.sum("n_invalid").alias("n_invalid"),
    )


def gradient(rows: DataFrame, weights: list[float], metric: str = "log_loss") -> Gradient:
    """Run :func:`gradient_sums`; one row of the size of the model comes to the driver."""
    (row,) = gradient_sums(rows, weights, metric).collect()
    if not row["n"]:
        return Gradient(0, None, None, row["n_invalid"])
    n = row["n"]
    return Gradient(n, row["error"] / n, [float(v) / n for v in row["g"].toArray()], row["n_invalid"])


def stepped(weights: list[float], grad: Gradient, rate: float) -> list[float]:
    """Weights after one step against the gradient; without rows they stay."""
    if grad.values is None:
        return list(weights)
    return [w - rate * g for w, g in zip(weights, grad.values, strict=True)]
