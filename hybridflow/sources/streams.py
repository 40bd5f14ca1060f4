"""Unbounded sources. Each returns a streaming frame; nothing connects before ``start()``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def socket_lines(spark: SparkSession, host: str, port: int, timestamps: bool = True) -> DataFrame:
    """Text lines from a socket with their arrival time. Not replayable: for trying things out."""
    return (
        spark.readStream.format("socket")
        .option("host", host)
        .option("port", port)
        .option("includeTimestamp", timestamps)
        .load()
    )


def kafka_options(
    servers: str, topic: str, start: str = "earliest", rows_per_trigger: int | None = 1_000_000
) -> dict[str, str]:
    """Options of the Kafka source; the row limit bounds what one micro-batch may hold."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if rows_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(rows_per_trigger)
    return options


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Raw messages of a topic: ``key``, ``value``, ``timestamp`` and more. Needs the Kafka package."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    max_bytes: str | None = "4g",
    max_files: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream.

    One of the two limits bounds a micro-batch; give ``max_files`` to limit by number.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "text":
        reader = reader.option("lineSep", "\n")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)
