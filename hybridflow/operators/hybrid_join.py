"""Joins of a stream, seen as an ordered table, with a finite batch table.

Per key there is one entry. Rows of the stream fold into it one by one; the batch side
gives it its attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybridflow.operators.keyed import ROWS_PER_TASK
from hybridflow.operators.rolling import Fold, fold_totals, rolling_fold, with_values


def one_per_key(
    batch: DataFrame, key: list[str], attributes: list[str], latest_by: str | None = None
) -> DataFrame:
    """Fold a batch side with repeated keys to one row per key.

    The row with the highest ``latest_by`` wins, or else the highest attribute values;
    either way the choice does not depend on the order of reading.
    """
    record = F.struct(*attributes)
    best = F.max_by(record, latest_by) if latest_by else F.max(record)
    return batch.groupBy(*key).agg(best.alias("_r")).select(*key, "_r.*")


def known_keys(batch: DataFrame, key: list[str]) -> DataFrame:
    """Batch rows with a key, folded to one per key."""
    known = batch.where(" and ".join(f"{k} is not null" for k in key))
    others = [c for c in batch.columns if c not in key]
    return one_per_key(known, key, others) if others else known.distinct()


def enrich(
    stream: DataFrame,
    batch: DataFrame,
    key: list[str],
    order: list[str],
    folds: list[Fold],
    rows_per_slice: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per stream row: the folds so far and the attributes of the key.

    Keys only the batch has give no row; keys it does not have give null attributes.
    Batch rows that repeat a key are folded to one. A null key finds no attributes.
    """
    known = batch.where(" and ".join(f"{k} is not null" for k in key))
    return with_values(rolling_fold(stream, key, order, folds, known, rows_per_slice, side_repeats=True), folds)


def snapshot(stream: DataFrame, batch: DataFrame, key: list[str], folds: list[Fold]) -> DataFrame:
    """The entry of every key of either side once the input has ended.

    Batch rows that repeat a key are folded to one; those without a key stay by themselves.
    """
    return with_values(entries_of(stream, batch, key, folds), folds)


def entries_of(stream: DataFrame, batch: DataFrame, key: list[str], folds: list[Fold]) -> DataFrame:
    """As :func:`snapshot`, with totals that can go on accumulating."""
    totals = fold_totals(stream, key, folds)
    keyless = batch.where(" or ".join(f"{k} is null" for k in key))
    joined = totals.join(known_keys(batch, key).unionByName(keyless), key, "full_outer")
    counts = {f.name: F.coalesce(F.col(f.name), F.lit(0)) for f in folds if f.kind == "count"}
    return joined.withColumns(counts) if counts else joined


def full(
    stream: DataFrame,
    batch: DataFrame,
    key: list[str],
    order: list[str],
    folds: list[Fold],
    complete_at: str,
    rows_per_slice: int = ROWS_PER_TASK,
) -> DataFrame:
    """Nothing until the batch side is complete, then every entry once, then one row per stream row.

    The batch side is complete once the first order column reaches ``complete_at``. Earlier
    rows are only aggregated; the entries flushed at completion are also what later rows
    start from. ``phase`` is ``flush`` for the entries and ``stream`` for the rows after them.
    """
    has_key = F.expr(" and ".join(f"{k} is not null" for k in key))
    at, time = F.lit(complete_at).cast(stream.schema[order[0]].dataType), F.col(order[0])
    early = stream.where(time.isNull() | (time < at))
    entries = entries_of(early, batch.where(has_key), key, folds)
    later = rolling_fold(stream.where(time >= at), key, order, folds, entries, rows_per_slice)
    attributes = [c for c in batch.columns if c not in key]
    shown = [*key, *order, *[f.name for f in folds], *attributes]
    keyless = entries_of(early.where(F.lit(False)), batch.where(~has_key), key, folds)
    flush = entries.unionByName(keyless)
    flush = flush.withColumns({c: F.lit(None).cast(stream.schema[c].dataType) for c in order})
    both = flush.select(F.lit("flush").alias("phase"), *shown).unionByName(
        later.select(F.lit("stream").alias("phase"), *shown)
    )
    return with_values(both, folds)
