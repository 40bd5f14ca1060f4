"""Two inputs of different type as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connect(first: DataFrame, second: DataFrame, tags: tuple[str, str] = ("stream", "batch")) -> DataFrame:
    """Rows of both inputs, ``side`` telling where each comes from; missing columns are null."""
    a = first.withColumn("side", F.lit(tags[0]))
    b = second.withColumn("side", F.lit(tags[1]))
    return a.unionByName(b, allowMissingColumns=True)
