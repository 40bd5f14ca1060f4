"""Folds and word counts over windows of event time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hybridflow.operators.rolling import Fold

CHUNK_SECONDS = 86_400


def panes(ts: Column, length: int, slide: int) -> Column:
    """Start of the pane a time lies in; every window is made of whole panes."""
    width = math.gcd(length, slide)
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / width) * width


def _window_ends(pane: Column, length: int, slide: int) -> Column:
    """Ends of the windows that hold a pane, as multiples of ``slide``; none between windows."""
    width = math.gcd(length, slide)
    first = F.ceil((pane + width) / slide) * slide
    last = F.floor((pane + length) / slide) * slide
    return F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("bigint")))


def window_runs(
    paned: DataFrame, key: list[str], folds: list[Fold], pane: str, length: int, slide: int
) -> DataFrame:
    """Totals per key and pane as totals per key and run of windows that hold the same panes.

    A run is all windows that end from ``first_end`` to ``last_end`` seconds, each multiple of
    ``slide``. ``paned`` has one row per key and pane.

    Panes are cut into blocks as long as a window, so a window is the end of one block and the
    beginning of the next. Folds run forwards and backwards inside each block, and a window merges
    one total of either; a pane costs the same however many windows hold it, also for ``min`` and
    ``max``, which no inverse function could take out again. A key's block is at most a window's panes,
    so a frequent key is the work of many tasks.
    """
    width = math.gcd(length, slide)
    size, step = length // width, slide // width
    names = [f.name for f in folds]
    placed = paned.select(*key, *names, F.floor(F.col(pane) / width).alias("_i"))
    placed = placed.withColumn("_block", F.floor(F.col("_i") / size))
    block = Window.partitionBy(*key, "_block")

    def running(order: Column) -> Column:
        frame = block.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.struct(*[f.over_totals(f.name).over(frame).alias(f.name) for f in folds])

    at = block.orderBy("_i")
    folded = placed.select(
        *key, "_i", "_block",
        running(F.asc("_i")).alias("_begin"), running(F.desc("_i")).alias("_end"),
        F.lag("_i").over(at).alias("_before"), F.lead("_i").over(at).isNull().alias("_last"),
    )
    # What changes at which window end, by number: the beginning grows when a pane has ended; the end of
    # the block before shrinks when a window starts behind a pane, down to nothing behind its last one.
    nothing, i, own = F.lit(None), F.col("_i"), F.col("_block")
    end = F.struct(F.col("_end").alias("v"))
    gone = F.struct(F.lit(None).cast(folded.schema["_end"].dataType).alias("v"))
    from_start = F.coalesce(F.col("_before"), own * size) + 1 + size

    def change(when: Column, block: Column, at: Column, begin: Column, end: Column) -> Column:
        fields = [block.alias("block"), at.alias("at"), begin.alias("begin"), end.alias("end")]
        return F.when(when, F.struct(*fields))

    changes = F.array(
        change(F.lit(True), own, i + 1, F.col("_begin"), nothing),
        change(i > own * size, own + 1, from_start, nothing, end),
        change(F.col("_last"), own + 1, i + 1 + size, nothing, gone),
    )
    changed = folded.select(*key, F.explode(F.filter(changes, lambda c: c.isNotNull())).alias("_c")).select(*key, "_c.*")
    later = Window.partitionBy(*key, "block").orderBy("at")
    so_far = later.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    runs = changed.select(
        *key, "at",
        F.last("begin", ignorenulls=True).over(so_far).alias("_b"),
        F.last("end", ignorenulls=True).over(so_far)["v"].alias("_e"),
        F.coalesce(F.lead("at").over(later) - 1, (F.col("block") + 1) * size).alias("to"),
    )
    merged = [f.merged(F.col("_b")[f.name], F.col("_e")[f.name]).alias(f.name) for f in folds]
    held = runs.where(F.col("_b").isNotNull() | F.col("_e").isNotNull())
    return held.select(
        *key, *merged,
        (F.ceil(F.col("at") / step) * slide).alias("first_end"), (F.floor(F.col("to") / step) * slide).alias("last_end"),
    ).where("first_end <= last_end")


def fold_panes(
    paned: DataFrame, key: list[str], folds: list[Fold], pane: str, length: int, slide: int
) -> DataFrame:
    """Totals per key and pane as totals per key and window, the window named by ``w_end``.

    ``paned`` has one row per key and pane. Windows are folded as :func:`window_runs` says;
    what is written out for every window is its result.
    """
    runs = window_runs(paned, key, folds, pane, length, slide)
    ends = F.sequence("first_end", "last_end", F.lit(slide).cast("bigint"))
    return runs.select(
        F.explode(ends).alias("w_end"),
        *key, *[f.name for f in folds],
    ).withColumn("w_end", F.timestamp_seconds("w_end"))


def windowed_fold(
    rows: DataFrame, key: list[str], folds: list[Fold], ts: str = "ts", length: int = 300, slide: int = 60
) -> DataFrame:
    """Folds per key and window of ``length`` seconds, a window ending every ``slide`` seconds.

    A window holds ``w_end - length <= ts < w_end``. Rows are folded per pane first, and panes to
    windows by :func:`fold_panes`. Rows without a time are in no window.
    For a stream fold the panes with ``totals_updates`` and the windows with :func:`fold_panes`.
    """
    paned = rows.where(F.col(ts).isNotNull()).groupBy(*key, panes(F.col(ts), length, slide).alias("_pane"))
    paned = paned.agg(*[f.over_rows().alias(f.name) for f in folds])
    return fold_panes(paned, key, folds, "_pane", length, slide)


def sliding_counts(
    words: DataFrame,
    ts: str = "ts",
    word: str = "word",
    length: int = 300,
    slide: int = 60,
    watermark: int | None = None,
) -> DataFrame:
    """Count per word and window, as :func:`windowed_fold` has windows.

    On a stream give ``watermark``, the seconds a row may be late; a window is then emitted
    once, when it has closed. Windows that are still open come from ``totals_updates`` over panes.
    """
    words = words.withColumnRenamed(word, "word")
    if not words.isStreaming:
        counts = windowed_fold(words, ["word"], [Fold("n", "count")], ts, length, slide)
        return counts.select("w_end", "word", "n")
    ends = F.explode(_window_ends(panes(F.col(ts), length, slide), length, slide)).alias("w_end")
    copied = words.select("word", ends).withColumn("w_end", F.timestamp_seconds("w_end"))
    if watermark is not None:
        copied = copied.withWatermark("w_end", f"{length + watermark} seconds")
    return copied.groupBy("w_end", "word").agg(F.count(F.lit(1)).alias("n"))


def trailing_counts(
    words: DataFrame,
    ts: str = "ts",
    word: str = "word",
    length: int = 300,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Count per word over the last ``length`` seconds, at each second the word occurs.

    Words are first counted per second. Seconds are cut into chunks of time, and each
    chunk also gets the seconds before it that its windows reach back to; a frequent
    word is then the work of many tasks of at most ``chunk_seconds + length`` rows.
    """
    if length > chunk_seconds:
        raise ValueError("a chunk must be at least as long as the window")
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    counted = (
        words.select(F.col(word).alias("word"), second.alias("s"))
        .groupBy("word", "s")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    chunk = F.floor(F.col("s") / chunk_seconds)
    reaching = F.floor((F.col("s") + length - 1) / chunk_seconds)
    placed = counted.select(
        "word", "s", "n", chunk.alias("home"), F.explode(F.sequence(chunk, reaching)).alias("chunk")
    )
    trailing = Window.partitionBy("word", "chunk").orderBy("s").rangeBetween(1 - length, 0)
    return (
        placed.withColumn("n", F.sum("n").over(trailing))
        .where(F.col("home") == F.col("chunk"))
        .select("word", F.timestamp_seconds("s").alias("at"), "n")
    )
