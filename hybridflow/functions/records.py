"""Decoding and encoding of messages, parsing of lines, tagged unions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode_json(payload: Column, schema: str) -> Column:
    """Message bytes or text to a struct; what cannot be decoded becomes null."""
    return F.from_json(payload.cast("string"), schema)


def encode_json(record: Column) -> Column:
    return F.to_json(record)


def decode_csv(payload: Column, schema: str) -> Column:
    """As :func:`decode_json` for comma-separated text: a bad field makes the record null."""
    text = payload.cast("string")
    record = F.from_csv(text, f"{schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    return F.when(record["_corrupt"].isNull() & text.isNotNull(), record.dropFields("_corrupt"))


def encode_csv(record: Column) -> Column:
    return F.to_csv(record)


def split_decoded(df: DataFrame, record: str) -> tuple[DataFrame, DataFrame]:
    """Good and bad messages as two frames, so that bad ones can be kept and looked at."""
    return df.where(F.col(record).isNotNull()), df.where(F.col(record).isNull())


def parse_lines(df: DataFrame, line: str, schema: str) -> DataFrame:
    """One record per line; a line that does not fit keeps its text in ``_corrupt``."""
    record = F.from_csv(
        F.col(line), f"{schema}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return df.select(record.alias("r")).select("r.*")


def parity(n: Column) -> Column:
    """``even`` or ``odd``; a negative odd number is odd too."""
    return F.when(n % 2 == 0, "even").otherwise("odd")


def left_side(record: Column) -> list[Column]:
    """Columns of a tagged union whose left value is set."""
    return [F.lit("left").alias("side"), record.alias("value")]


def right_side(like: DataFrame, value: str = "value") -> DataFrame:
    """One end marker in the shape of ``like``: right side, no value."""
    kind = like.schema[value].dataType
    return like.sparkSession.range(1).select(
        F.lit("right").alias("side"), F.lit(None).cast(kind).alias(value)
    )


def map_left(df: DataFrame, fn: Callable[[Column], Column], value: str = "value") -> DataFrame:
    """Transform left values and let right ones through as they are."""
    return df.withColumn(value, F.when(F.col("side") == "left", fn(F.col(value))))
