"""Vectors as ``ARRAY<DOUBLE>`` columns and the parts of logistic scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(x: Column, weights: list[float]) -> Column:
    products = F.zip_with(x, F.lit([float(w) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def logistic(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def predict(x: Column, weights: list[float]) -> Column:
    """Probability of the positive class."""
    return logistic(dot(x, weights))


def log_loss(p: Column, y: Column) -> Column:
    """Kept finite at p = 0 and p = 1."""
    safe = F.greatest(F.least(p, F.lit(1.0 - 1e-15)), F.lit(1e-15))
    return -(y * F.ln(safe) + (1.0 - y) * F.ln(1.0 - safe))


def misclassified(p: Column, y: Column) -> Column:
    return F.when((p >= 0.5) == (y >= 0.5), 0.0).otherwise(1.0)


def vector_add(a: Column, b: Column) -> Column:
    """Element-wise sum; vectors of different size are an error, not a padded result."""
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda u, v: u + v)).otherwise(
        F.raise_error(F.lit("vectors differ in size")).cast("array<double>")
    )


def parse_labeled_vector(line: Column, n_features: int) -> Column:
    """``label,x1,…,xn`` to a struct; a line with another number of values gives null."""
    parts = F.split(line, ",")
    numbers = F.transform(parts, lambda s: F.trim(s).try_cast("double"))
    record = F.struct(
        numbers[0].alias("label"),
        F.slice(numbers, 2, n_features).alias("features"),
    )
    complete = (F.size(parts) == n_features + 1) & ~F.exists(numbers, lambda v: v.isNull())
    return F.when(complete, record)
