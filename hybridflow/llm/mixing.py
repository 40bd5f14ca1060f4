"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target in words: its weight's share of the mix, at most ``epochs`` times its own
size, the excess shared anew by weight (a water level: target = min(cap, level * weight)). A source
gives as many complete epochs as fit its target; the rest is filled by a weighted sample without
replacement: documents in the order of exponential keys, ``-ln(u) / quality``, until their prefix
sum of words reaches the rest. The last document is taken in part, so that a source meets its
target to the word.

No task holds a source: its documents are dealt into ranges of the key holding about
``rows_per_range`` each, the ranges' sums give each range its start, and rows are summed within a
range. Sources need one row each in the plan of targets.

Defined results: a null or blank text has size 0 and is taken 0 times. A null source is a source of
its own, last in the order of code points. Rows that repeat id and text are separate documents, and stand
next to each other in the sample; however many there are, they are placed as one. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hybridflow.llm.common import Cuts, ready

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
ROWS_PER_RANGE = 10_000
#: Copies of a row that one task tells apart at a time.
COPIES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """0.25 to 1: the share of letters in the text, so that symbol junk is taken late."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.coalesce(0.25 + 0.75 * letters / F.greatest(F.length(text), F.lit(1)), F.lit(0.25))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(totals: DataFrame, weights: Sequence[int], share: float, epochs: int) -> DataFrame:
    """``source, source_size, n_docs`` with ``target`` added: one row per source throughout."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(epochs)
    plan = totals.withColumn("place", place).withColumn("weight", weight).withColumn("cap", cap)
    full = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = F.sum("source_size").over(everywhere) * share
    level = (want - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    plan = plan.withColumn("level", level).withColumn("rank", F.row_number().over(full))
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("rank", "level"))
    at = F.min(fits).over(everywhere)["level"]
    target = F.least(F.col("cap"), F.coalesce(at * F.col("weight"), F.col("cap")))
    return plan.withColumn("target", target).select("source", "source_size", "n_docs", "target")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = 17,
    rows_per_range: int = ROWS_PER_RANGE,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken, repeats``, and ``extra`` columns.

    ``taken`` counts words with repeats; ``repeats`` are the complete copies, and what ``taken`` holds
    beyond them are the first words of one more.
    """
    spark = ready(docs.sparkSession)
    cuts = Cuts(spark, "mix")
    key = -F.log(uniform(docs["doc_id"], seed)) / quality(docs["text"])
    base = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        n_words(docs["text"]).alias("size"),
        key.alias("key"),
        *[docs[c].alias(f"extra_{c}") for c in extra],
    )
    # Rows that are alike in all of this are one row with their number until they have been placed.
    base = cuts.cut(base.groupBy(*base.columns).agg(F.count("*").alias("copies")))
    totals = base.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("n_docs"))
    plan = targets(totals, weights, share, epochs).withColumnRenamed("source", "s")
    rows = base.join(plan, base["source"].eqNullSafe(plan["s"])).drop("s")
    span = F.floor(F.col("key") * F.ceil(F.col("n_docs") / rows_per_range)).cast("long")
    rows = rows.withColumn("span", span)
    spans = rows.groupBy(F.col("source").alias("s"), F.col("span").alias("p")).agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    earlier = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select("s", "p", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    rows = rows.join(starts, rows["source"].eqNullSafe(starts["s"]) & (rows["span"] == starts["p"])).drop("s", "p")
    ahead = Window.partitionBy("source", "span").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.col("start") + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(ahead), F.lit(0))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("prefix")))
    rows = rows.withColumn("first", prefix).withColumn("whole", whole).withColumn("rest", rest)
    # Copies follow each other; many of them are told apart by several tasks.
    parts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))
    rows = rows.withColumn("begin", F.explode(parts))
    if (base.agg(F.max("copies")).first()[0] or 0) > COPIES:
        rows = rows.repartition("source", "key", "begin")
    end = F.least(F.col("begin") + COPIES, F.col("copies")) - 1
    rows = rows.withColumn("copy", F.explode(F.sequence("begin", end))).withColumn("prefix", F.col("first") + F.col("copy") * F.col("size"))
    taken = (F.col("whole") * F.col("size") + part).cast("long")
    repeats = (F.col("whole") + F.when((part == F.col("size")) & (part > 0), 1).otherwise(0)).cast("long")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), repeats.alias("repeats"),
        *[F.col(f"extra_{c}").alias(c) for c in extra],
    )
