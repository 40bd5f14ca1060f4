"""Line and word functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_cr(line: Column) -> Column:
    """Drop one carriage return at the very end of the line, and only one."""
    return F.when(
        F.endswith(line, F.lit("\r")), F.substring(line, F.lit(1), F.length(line) - 1)
    ).otherwise(line)


def split_blank(line: Column) -> Column:
    """Split on single blanks; empty words stay at the front and inside, not at the end.

    An empty line is one empty word; a line of blanks only has no words at all.
    """
    kept = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, " "))
    )


def lines_of(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per newline-separated line of a text column."""
    return df.select(*keep, F.explode(F.split(F.col(text), "\n")).alias("line"))


def words_of(df: DataFrame, line: str, *keep: str) -> DataFrame:
    """One row per word of a line column; works on static and streaming input."""
    return df.select(*keep, F.explode(split_blank(F.col(line))).alias("word"))


def paired_with_one(df: DataFrame, word: str = "word", *keep: str) -> DataFrame:
    """The pair (word, 1), the input of every counting reduce."""
    return df.select(*keep, word, F.lit(1).cast("bigint").alias("one"))
