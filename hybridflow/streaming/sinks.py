"""Sinks of streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def first_rows(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows, as a print sink shows them. No full sort: each task keeps ``n``."""
    return df.orderBy(*order).limit(n)


def print_stream(stream: DataFrame, rows: int = 10, mode: str = "append") -> DataStreamWriter:
    return stream.writeStream.format("console").option("numRows", rows).outputMode(mode)


def batch_folder(
    path: str, fn: Callable[[DataFrame, int], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: write each micro-batch to its own folder below ``path``.

    A micro-batch that is run again after a failure replaces its folder, so its rows
    are there once. ``fn`` may turn the micro-batch into what is to be written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = fn(batch, batch_id) if fn else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def per_batch_totals(key: list[str], value: str, alias: str = "total") -> Callable[[DataFrame, int], DataFrame]:
    """For :func:`batch_folder`: sum per key inside the micro-batch, forgotten after it."""

    def reduce(rows: DataFrame, batch_id: int) -> DataFrame:
        return rows.groupBy(*key).agg(F.sum(value).alias(alias))

    return reduce


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`batch_folder` wrote, with its ``batch_id``."""
    return spark.read.parquet(path)


def every(writer: DataStreamWriter, interval: str = "1 second") -> DataStreamWriter:
    """Run until stopped, a micro-batch per interval."""
    return writer.trigger(processingTime=interval)
