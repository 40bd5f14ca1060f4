"""Inline elements and parquet tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def inline_elements(spark: SparkSession, elements: Iterable, schema: str = "value INT") -> DataFrame:
    """A small bounded input written in the program: single values or tuples."""
    rows = [e if isinstance(e, tuple) else (e,) for e in elements]
    return spark.createDataFrame(rows, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
