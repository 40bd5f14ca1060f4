"""User functions written in Python, run on Arrow batches.

Column expressions come first; these are for functions that cannot be written as such.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Partial results a task keeps before it passes them on.
KEYS_HELD = 100_000


def map_values(fn: Callable[[pd.Series], pd.Series], return_type: str) -> Callable[[Column], Column]:
    """A vectorised 1→1 user function as a column function."""

    def mapped(values: pd.Series) -> pd.Series:
        return fn(values)

    return F.pandas_udf(mapped, return_type)


def filter_values(fn: Callable[[pd.Series], pd.Series]) -> Callable[[Column], Column]:
    """A vectorised user predicate, for ``DataFrame.where``."""
    return map_values(fn, "boolean")


def flat_map_values(
    fn: Callable[[object], list], element_type: str
) -> Callable[[Column], Column]:
    """A 1→0..n user function; a value without results drops its row."""

    def mapped(values: pd.Series) -> pd.Series:
        return values.map(fn)

    udf = F.pandas_udf(mapped, f"array<{element_type}>")
    return lambda column: F.explode(udf(column))


def reduce_by_key(
    df: DataFrame,
    key: str,
    value: str,
    fn: Callable[[object, object], object],
    branches: int = 64,
) -> DataFrame:
    """Reduce a key's values with an associative, commutative user function.

    Rows are reduced in the task that reads them, then partial results meet in
    ``branches`` groups per key, then those meet once more. A key that holds most of
    the rows therefore never has more than partial results in one task.
    """
    schema = df.select(key, value).schema

    def add(totals: dict, rows: pa.RecordBatch | pa.Table) -> None:
        for k, v in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            totals[k] = fn(totals[k], v) if k in totals else v

    def columns(totals: dict, kinds: pa.Schema) -> list[pa.Array]:
        return [pa.array(totals.keys(), kinds.types[0]), pa.array(totals.values(), kinds.types[1])]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, kinds = {}, None
        for batch in batches:
            kinds = batch.schema
            add(totals, batch)
            if len(totals) >= KEYS_HELD:
                yield pa.RecordBatch.from_arrays(columns(totals, kinds), [key, value])
                totals = {}
        if totals:
            yield pa.RecordBatch.from_arrays(columns(totals, kinds), [key, value])

    def merge(parts: pa.Table) -> pa.Table:
        parts, totals = parts.select([key, value]), {}
        add(totals, parts)
        return pa.Table.from_arrays(columns(totals, parts.schema), [key, value])

    branch = F.pmod(F.spark_partition_id(), F.lit(branches)).alias("branch")
    parts = df.select(key, value).mapInArrow(partial, schema)
    return (
        parts.groupBy(key, branch).applyInArrow(merge, schema).groupBy(key).applyInArrow(merge, schema)
    )
