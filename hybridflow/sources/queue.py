"""A queue of batches as a stream: every queued frame becomes one micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from hybridflow.session import new_path

Sink = Callable[[DataFrame], DataStreamWriter]


class BatchQueue:
    """Feeds frames to a streaming query one after the other.

    A frame is written as ordinary files, as many as it has partitions, and the query
    is then run to the end of what is there. The checkpoint carries state and batch
    numbers from one run to the next, so the queue can also be picked up after a stop.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, checkpoint: str | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "queue")
        self.checkpoint = checkpoint or new_path(spark, "queue-checkpoint")

    def push(self, batch: DataFrame) -> None:
        batch.write.mode("append").parquet(self.path)

    def stream(self, like: DataFrame) -> DataFrame:
        return self.spark.readStream.schema(like.schema).parquet(self.path)

    def run(self, batches: Iterable[DataFrame], sink: Sink) -> None:
        """Push each frame and let ``sink(stream)`` consume it before the next one comes."""
        for batch in batches:
            self.push(batch)
            writer = sink(self.stream(batch)).option("checkpointLocation", self.checkpoint)
            writer.trigger(availableNow=True).start().awaitTermination()


def split_at(df: DataFrame, column: str, cuts: list) -> list[DataFrame]:
    """A table as consecutive batches: below the first cut, between cuts, from the last cut on.

    Each batch is a range filter, which the scan uses to skip what lies outside.
    Rows without a value go to the first batch.
    """
    c = F.col(column)
    at = [F.lit(cut).cast(df.schema[column].dataType) for cut in cuts]
    batches = [df.where(c.isNull() | (c < at[0]))]
    batches += [df.where((c >= a) & (c < b)) for a, b in zip(at, at[1:])]
    return [*batches, df.where(c >= at[-1])]
