"""Bounded text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window

from hybridflow.functions.words import strip_cr
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str], delimiter: str = "\n") -> DataFrame:
    """One row per line ended by the delimiter, of any length. Other line ends stay inside the line."""
    return spark.read.option("lineSep", delimiter).text(path)


def read_clean_lines(spark: SparkSession, path: str | list[str], delimiter: str = "\n") -> DataFrame:
    """As :func:`read_lines`; lines ended by a newline lose the ``\\r`` of Windows line ends."""
    lines = read_lines(spark, path, delimiter)
    return lines.withColumn("value", strip_cr(F.col("value"))) if delimiter == "\n" else lines


def numbered_lines(spark: SparkSession, path: str | list[str], delimiter: str = "\n") -> DataFrame:
    """Lines with ``file_name`` and ``line_no``, their number from 1 over all files in the order of their paths.

    Spark reads a text in splits, in any order. Lines are counted per split, a split's first number is the
    sum of the splits before it, and a line adds its place in its split; so no task reads more than its
    splits, and what is summed is a row per split.
    """
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = read_lines(spark, path, delimiter).select(
        "value", F.col("_metadata.file_name").alias("file_name"), split.alias("split"), F.monotonically_increasing_id().alias("id")
    )
    # A split lies within one partition, where ids are consecutive.
    counts = lines.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    before = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("split").alias("_split"), "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before")
    )
    number = F.col("lines_before") + F.col("id") - F.col("first_id") + 1
    return lines.join(starts, F.col("split") == F.col("_split")).select("file_name", number.alias("line_no"), "value")


def history_ready(spark: SparkSession, path: str) -> bool:
    """Whether the job that writes ``path`` has committed all of it.

    This is the end-of-batch signal: the commit marker exists once for the whole
    dataset, however many files it has.
    """
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(marker)
