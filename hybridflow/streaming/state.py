"""Keyed state of a streaming query as a table, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def state_table(spark: SparkSession, checkpoint: str, variable: str, batch_id: int | None = None) -> DataFrame:
    """A row per entry of a state variable: the grouping key's columns, then those of the entry.

    A value state has an entry per grouping key, a list state one per element, a map state one per map key.
    Without ``batch_id`` it is the state after the last micro-batch that was committed; the query may be
    running or stopped.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load()
    return state.select(*[f"{c}.*" for c in state.columns if c != "partition_id"])
