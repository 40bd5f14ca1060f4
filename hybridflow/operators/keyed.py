"""Partitioning by key, spreading, and reducing by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to so many hot keys are broadcast; more are joined as a table.
BROADCAST_KEYS = 10_000
ROWS_PER_TASK = 1_000_000


def rows_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """Number of rows of each key as ``n_rows``, counted before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))


def hot_keys(counts: DataFrame, rows_per_task: int) -> tuple[DataFrame, int, bool] | None:
    """Of all keys with their ``n_rows``, those with more than one task should hold.

    Gives them, the number of rows they have together, and whether they are few enough for a
    broadcast; or None if there are none. However many there are, all count as hot.
    """
    large = counts.where(F.col("n_rows") > rows_per_task)
    n, n_rows = large.agg(F.count(F.lit(1)), F.sum("n_rows")).first()
    if not n:
        return None
    if n > BROADCAST_KEYS:
        return large, n_rows, False
    return counts.sparkSession.createDataFrame(large.collect(), counts.schema), n_rows, True


def with_key_slots(df: DataFrame, key: list[str]) -> tuple[DataFrame, list[str]]:
    """Add non-null stand-ins for the key columns, so that null keys group and join like others.

    A null-safe join cannot use the partitioning of a window on the same key; an equality
    on these columns can.
    """
    names, columns = [], {}
    for i, name in enumerate(key):
        kind = df.schema[name].dataType.simpleString()
        blank = "1970-01-01" if kind in ("date", "timestamp", "timestamp_ntz") else "0"
        blank = "false" if kind == "boolean" else blank
        columns[f"_key{i}"] = F.coalesce(F.col(name), F.lit(blank).cast(kind))
        columns[f"_null{i}"] = F.col(name).isNull()
        names += [f"_key{i}", f"_null{i}"]
    return df.withColumns(columns), names


def key_by(
    df: DataFrame, key: list[str], spread_on: str, shares: int, partitions: int | None = None
) -> DataFrame:
    """Put rows of the same ``(key, share)`` into the same partition.

    Every key has ``shares`` shares, whatever its size; ``spread_on`` picks a row's. With one
    share a key's rows are all together, and a key that dominates is the work of one task.

    Use it only where per-partition code needs the rows together: joins, windows and
    aggregates partition by themselves.
    """
    df = df.withColumn("share", F.pmod(F.xxhash64(spread_on), F.lit(shares)))
    target = [*key, "share"]
    return df.repartition(partitions, *target) if partitions else df.repartition(*target)


def random_spread(df: DataFrame, partitions: int) -> DataFrame:
    """Deal rows out evenly, whatever they hold."""
    return df.repartition(partitions)


def totals_by_key(df: DataFrame, key: list[str], value: str, alias: str = "total") -> DataFrame:
    """Final sum per key. Rows are summed before the shuffle, so a hot key costs nothing extra."""
    return df.groupBy(*key).agg(F.sum(value).alias(alias))


def totals_per_batch(
    df: DataFrame, batch: Column, key: list[str], value: str, alias: str = "total"
) -> DataFrame:
    """Sum per key inside each batch, forgotten after it."""
    return df.groupBy(batch.alias("batch"), *key).agg(F.sum(value).alias(alias))
