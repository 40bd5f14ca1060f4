"""Shards that all match the mixture, by proportional stratified interleaving; DataFrame functions only.

The rows of each source are shuffled by a seeded key and ranked. A row's fractional rank is
``(rank + offset) / rows of the source`` with a seeded offset in (0, 1) per source, so any stretch of
fractional ranks holds each source's share of it to within a row, and sources of one row lie anywhere.
Rows are put in the order of fractional ranks, and the order is cut into shards whose row counts
differ by one at most (the law ``rows``). Within a shard rows stay in that order.

No task holds a source, a shard or the order: rows are dealt into ranges of the key or of the
fractional rank of about ``rows_per_range`` rows each, a range's first rank comes from the counts of the
ranges before it (summed by blocks of ranges first), and rows are ranked within a range. What is
shuffled is ids, sizes and checksums; texts move only in :func:`write_shards`.

Defined results: a null text has size 1 and checksum 0, as an empty one. A null source is a source of
its own. Rows equal in all columns are folded to one with their number, and told apart again by numbering
the copies, so that each is shuffled by a key of its own and no task holds them all. A null id is
an id like others, ordered first. An empty table gives no rows. Extra columns of any name are kept by
:func:`write_shards` (but for its own ``shard`` and ``slot``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hybridflow.llm.common import Cuts, ready
from hybridflow.llm.mixing import uniform

SHARDS = 16
SEED = 29
ROWS_PER_RANGE = 10_000
#: Ranges are summed by blocks of so many; copies of a row are told apart by so many at a time.
BLOCK = 1_000
SALTS = 64

LAW = "rows"


def row_hash(docs: DataFrame) -> Column:
    """Of all columns of a row."""
    return F.xxhash64(*[docs[c] for c in docs.columns])


def _source_key(source: Column) -> Column:
    """Non-null stand-in, so that joins and windows on it share a partitioning."""
    return F.concat(F.when(source.isNull(), F.lit("-")).otherwise(F.lit("+")), F.coalesce(source, F.lit("")))


def folded_rows(docs: DataFrame) -> DataFrame:
    """Rows without their texts, equal ones as one with their number ``n``."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        row_hash(docs).alias("hash"),
    )
    folded = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    return folded.withColumn("s", _source_key(F.col("source")))


def copies_of(folded: DataFrame, seed: int) -> DataFrame:
    """A row per copy with a seeded ``key`` in (0, 1); rows with many copies are told apart by several tasks."""

    def told(rows: DataFrame, begin: Column) -> DataFrame:
        end = F.least(begin + BLOCK, F.col("n")) - 1
        return rows.withColumn("copy", F.explode(F.sequence(begin, end)))

    none = F.lit(0).cast("long")
    few = told(folded.where(F.col("n") <= BLOCK), none)
    many = folded.where(F.col("n") > BLOCK).withColumn("part", F.explode(F.sequence(none, F.floor((F.col("n") - 1) / BLOCK))))
    many = told(many.repartition("hash", "part"), F.col("part") * BLOCK).drop("part")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", "copy")
    return few.unionByName(many).withColumn("key", uniform(name, seed)).drop("n")


def firsts(counts: DataFrame, group: list[str]) -> DataFrame:
    """``group, range, n`` with ``first``: how many come before each range of its group."""
    placed = counts.withColumn("block", F.floor(F.col("range") / BLOCK))
    blocks = placed.groupBy(*group, "block").agg(F.sum("n").alias("block_n"))
    earlier = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*group, "block", F.coalesce(F.sum("block_n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*group, "block").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return placed.join(blocks, [*group, "block"]).select(*group, "range", first.alias("first"))


def assign(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, size, text_crc32, hash, shard, slot``; slots count from 0 in each shard."""
    spark = ready(docs.sparkSession)
    cuts = Cuts(spark, "shards")
    folded = cuts.cut(folded_rows(docs))
    offset = F.first(uniform(F.concat(F.lit("source:"), "s"), seed))
    totals = folded.groupBy("s").agg(F.sum("n").alias("source_n"), offset.alias("offset"))
    total = folded.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Salted, so that no task holds a source's rows if there are too many sources for a broadcast.
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = copies_of(folded, seed).withColumn("salt", F.pmod(F.col("hash") + F.col("copy"), F.lit(SALTS)).cast("int"))
    rows = rows.join(salted, ["s", "salt"]).drop("salt")
    spans = F.ceil(F.col("source_n") / rows_per_range)
    rows = cuts.cut(rows.withColumn("range", F.floor(F.col("key") * spans).cast("long")))
    starts = firsts(rows.groupBy("s", "range").agg(F.count(F.lit(1)).alias("n")), ["s"])
    shuffled = Window.partitionBy("s", "range").orderBy("key", "doc_id", "size", "text_crc32", "hash", "copy")
    rank = F.col("first") + F.row_number().over(shuffled) - 1
    ranked = rows.join(starts, ["s", "range"]).withColumn("rank", rank)
    fraction = (F.col("rank").cast("double") + F.col("offset")) / F.col("source_n")
    ranges = -(-total // rows_per_range)
    single = ranked.withColumn("fraction", fraction).withColumn("range", F.floor(F.col("fraction") * ranges).cast("long"))
    single = cuts.cut(single.drop("key", "offset", "source_n", "first", "copy"))
    cuts.drop(folded, rows)
    starts = firsts(single.groupBy("range").agg(F.count(F.lit(1)).alias("n")), [])
    within = Window.partitionBy("range").orderBy("fraction", "s", "rank")
    place = F.col("first") + F.row_number().over(within) - 1
    placed = single.join(starts, "range").withColumn("place", place)
    shard = F.expr(f"place * {n_shards} div {max(total, 1)}")
    begin = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("place") - begin)
    return placed.select("doc_id", "source", "size", "text_crc32", "hash", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, seed: int = SEED) -> None:
    """``docs`` as Parquet, a folder ``shard=k`` per shard, its files in the order of ``slot``.

    Equal rows of ``docs`` are made one, and it meets each of their places.
    """
    places = assign(docs, n_shards, seed).select(F.col("hash").alias("_hash"), "shard", "slot")
    rows = docs.drop("shard", "slot").withColumn("_hash", row_hash(docs)).distinct()
    placed = rows.join(places, "_hash").drop("_hash").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").parquet(path)
