"""Daily files over a trailing window of days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.sources.archives import TASK_BYTES, list_archives, list_members, read_members

# Fixed value: the naming rule of the daily files.
DAY_FORMAT = "yyyyMMdd"
FILE_SUFFIX = ".export.CSV"
ARCHIVE_SUFFIX = ".export.CSV.zip"


def window_days(end: date, days: int) -> tuple[date, date]:
    """First and last day of the window: the ``days - 1`` full days before ``end``.

    ``end`` itself is not complete yet and is left out.
    """
    return end - timedelta(days=days - 1), end - timedelta(days=1)


def file_key(day: Column, suffix: str = ARCHIVE_SUFFIX) -> Column:
    """Name of the file that holds a day."""
    return F.concat(F.date_format(day, DAY_FORMAT), F.lit(suffix))


def day_of_file(name: Column) -> Column:
    """Day in a file name; null for a name that does not follow the rule."""
    digits = F.regexp_extract(name, r"(?:^|/)(\d{8})\.export\.CSV(?:\.zip)?$", 1)
    return F.try_to_timestamp(digits, F.lit(DAY_FORMAT)).cast("date")


def in_window(day: Column, end: date, days: int) -> Column:
    first, last = window_days(end, days)
    return day.between(F.lit(first), F.lit(last))


def daily_lines(spark: SparkSession, folder: str, end: date, days: int) -> DataFrame:
    """Lines of the unpacked daily files in the window, with where they come from.

    The day is taken from the file name, which Spark knows before it opens a file, so
    files outside the window are not read. ``(file_name, block_start, line_no)`` is the
    order of lines.
    """
    lines = spark.read.option("lineSep", "\n").text(f"{folder}/*{FILE_SUFFIX}")
    return lines.where(in_window(day_of_file(F.col("_metadata.file_name")), end, days)).select(
        day_of_file(F.col("_metadata.file_name")).alias("file_date"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def archives(spark: SparkSession, folder: str, end: date, days: int) -> DataFrame:
    """Zipped daily files of the window below a folder: ``path``, ``file_name`` and ``length``.

    Only names are looked at; no file is opened.
    """
    listed = list_archives(spark, folder, f"*{ARCHIVE_SUFFIX}")
    return listed.where(in_window(day_of_file(F.col("file_name")), end, days))


def unzip_lines(zipped: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Lines of archives as :func:`archives` lists them, with the day of the archive's name.

    Members are read by their byte ranges, so a large archive is the work of many tasks.
    """
    n_bytes = zipped.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    lines = read_members(list_members(zipped), n_bytes, task_bytes)
    name = F.element_at(F.split("member", "/"), -1).alias("file_name")
    return lines.select(day_of_file(F.col("path")).alias("file_date"), "path", "member", name, "line_no", "value")


def write_by_day(lines: DataFrame, path: str) -> None:
    """The window as a table partitioned by day; later windows read only their days.

    Rows of a day are brought together before writing; a day too large for one file is
    split, and small ones share a task.
    """
    lines.hint("rebalance", "file_date").write.mode("overwrite").partitionBy("file_date").parquet(path)


def write_master(lines: DataFrame, order: list[str], path: str, parts: int) -> None:
    """The window as one text in the order of file names and lines.

    The text is cut into ``parts`` files: their names sort in text order, so reading or
    concatenating them by name gives the whole, and no task holds all of it.
    """
    ordered = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.select("value").write.mode("overwrite").text(path)
