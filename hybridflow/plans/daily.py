"""Daily files of the event table over a trailing window that ends on its last day."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.session import new_path
from hybridflow.sources.archives import write_zip
from hybridflow.sources.daily import (
    ARCHIVE_SUFFIX,
    DAY_FORMAT,
    FILE_SUFFIX,
    archives,
    file_key,
    in_window,
    unzip_lines,
    write_by_day,
    write_master,
)
from hybridflow.sources.tables import table
from hybridflow.sources.text import numbered_lines, read_lines

DAYS = 15
LINES_PER_PART = 100_000
LINES_PER_MEMBER = 25_000
MEMBERS_PER_ARCHIVE = 40


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    line = F.concat_ws("\t", "event_id", "user_id", "event_type")
    return table(spark, folder, "events").select(
        F.to_date("ts").alias("file_date"), "event_id", line.alias("value")
    )


def _last_day(lines: DataFrame):
    return lines.agg(F.max("file_date")).first()[0]


def _write_archives(lines: DataFrame, folder: str) -> None:
    """The lines of each day as zip archives below ``folder``, each share of a day a member of its own."""
    shares = lines.groupBy("file_date").agg(
        F.ceil(F.count(F.lit(1)) / LINES_PER_MEMBER).alias("shares")
    )
    share = F.pmod(F.xxhash64("event_id"), F.col("shares"))
    # One row per day, so a day is always dealt into its shares before it is shuffled.
    placed = lines.join(F.broadcast(shares), "file_date").withColumn("share", share)
    day = F.date_format("file_date", DAY_FORMAT)
    placed = placed.select(
        F.concat(F.floor(F.col("share") / MEMBERS_PER_ARCHIVE), F.lit("/"), day, F.lit(ARCHIVE_SUFFIX)).alias("archive"),
        F.concat(day, F.lit(FILE_SUFFIX)).alias("name"), "share", "event_id", "value",
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        for archive, held in itertools.groupby(rows, key=lambda r: r.archive):
            members = ((m[0] if m[1] == 0 else f"{m[1]}/{m[0]}", (r.value for r in own)) for m, own in itertools.groupby(held, key=lambda r: (r.name, r.share)))
            yield pd.DataFrame({"path": [archive], "length": [write_zip(f"{folder}/{archive}", members)]})

    order = ["archive", "share", "event_id"]
    packed = placed.repartition("archive").sortWithinPartitions(*order).mapInPandas(pack, "path STRING, length BIGINT")
    packed.write.mode("overwrite").parquet(f"{folder}-written")


def date_keys(spark, folder):
    lines = _lines(spark, folder)
    end = _last_day(lines)
    return lines.groupBy("file_date").agg(F.count(F.lit(1)).alias("n")).select(
        F.date_format("file_date", DAY_FORMAT).alias("day"),
        file_key(F.col("file_date")).alias("file_name"),
        in_window(F.col("file_date"), end, DAYS).alias("in_window"),
        "n",
    )


def daily_window_union(spark, folder):
    path = new_path(spark, "daily")
    lines = _lines(spark, folder)
    write_by_day(lines.select("file_date", "value"), path)
    read = spark.read.parquet(path).where(in_window(F.col("file_date"), _last_day(lines), DAYS))
    return read.groupBy("file_date", "value").agg(F.count(F.lit(1)).alias("n")).select(
        F.date_format("file_date", DAY_FORMAT).alias("day"), "value", "n"
    )


def daily_unzip(spark, folder):
    """Zipped days, each member read by its byte range; archives outside the window are not opened."""
    lines, path = _lines(spark, folder), new_path(spark, "archives")
    _write_archives(lines, path)
    unpacked = unzip_lines(archives(spark, path, _last_day(lines), DAYS))
    return unpacked.select(F.date_format("file_date", DAY_FORMAT).alias("day"), "file_name", "value")


def daily_master_file(spark, folder):
    path = new_path(spark, "master")
    lines = _lines(spark, folder)
    wanted = lines.where(in_window(F.col("file_date"), _last_day(lines), DAYS))
    parts = 1 + wanted.count() // LINES_PER_PART
    write_master(wanted, ["file_date", "event_id"], path, parts=parts)
    return read_lines(spark, path)


def daily_numbered_lines(spark, folder):
    """The lines of the window's master file with their numbers in it, from files cut anywhere."""
    path = new_path(spark, "numbered")
    lines = _lines(spark, folder)
    wanted = lines.where(in_window(F.col("file_date"), _last_day(lines), DAYS))
    write_master(wanted, ["file_date", "event_id"], path, parts=8)
    return numbered_lines(spark, path).select("line_no", "value")


QUERIES = {
    "date_keys": date_keys,
    "daily_window_union": daily_window_union,
    "daily_unzip": daily_unzip,
    "daily_master_file": daily_master_file,
    "daily_numbered_lines": daily_numbered_lines,
}

_LINES = """
    SELECT event_id, CAST(ts AS DATE) AS d, strftime(ts, '%Y%m%d') AS day,
           event_id || chr(9) || user_id || chr(9) || event_type AS value,
           (SELECT CAST(max(ts) AS DATE) FROM events) AS last
    FROM events"""
_WINDOW = f"SELECT * FROM ({_LINES}) WHERE d BETWEEN last - {DAYS - 1} AND last - 1"

SQL = {
    "date_keys": f"""
        SELECT day, day || '.export.CSV.zip' AS file_name,
               bool_and(d BETWEEN last - {DAYS - 1} AND last - 1) AS in_window, count(*) AS n
        FROM ({_LINES}) GROUP BY day""",
    "daily_window_union": f"SELECT day, value, count(*) AS n FROM ({_WINDOW}) GROUP BY day, value",
    "daily_unzip": f"SELECT day, day || '.export.CSV' AS file_name, value FROM ({_WINDOW})",
    "daily_master_file": f"SELECT value FROM ({_WINDOW})",
    "daily_numbered_lines": f"SELECT row_number() OVER (ORDER BY d, event_id) AS line_no, value FROM ({_WINDOW})",
}
