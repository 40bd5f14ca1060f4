"""Line dedup by overlapping windows of consecutive lines, in DataFrame functions only.

Every run of ``window`` consecutive lines is fingerprinted where the text is read. A window found
more than once anywhere keeps its first place, by (doc_id, line); the lines that its later places
cover are removed, overlapping covers merged. What is shuffled is fingerprints and positions;
counting combines in the reading task, so a window that a third of all documents hold costs one row
per task. Texts meet only the positions of their own lines.

Defined results: a null text has no lines and stays null; an empty text is one empty line. Windows of
blank lines alone are no repeats. A text of fewer lines than a window stays as it is. Rows that
repeat doc_id and text are one document; a null doc_id sorts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hybridflow.llm.common import keyed_text, ready, same_row, text_tag

WINDOW = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_rows(texts: DataFrame, window: int) -> DataFrame:
    """A row per window: two fingerprints of its lines, and its place."""
    lines = F.col("lines")

    def at(i):
        part = [F.get(lines, i + k) for k in range(window)]
        return F.struct(
            F.xxhash64(*part).alias("a"),
            F.xxhash64(F.lit(window), *part[::-1]).alias("b"),
            (F.trim(F.translate(F.concat(*part), "\t\r\f\x0b", "    ")) != "").alias("filled"),
            i.cast("int").alias("line"),
        )

    starts = F.sequence(F.lit(0), F.size("lines") - window)
    return (
        texts.select("doc_id", "tag", lines_of(F.col("text")).alias("lines"))
        .where(F.size("lines") >= window)
        .select("doc_id", "tag", F.explode(F.transform(starts, at)).alias("w"))
        .where("w.filled")
        .select("w.a", "w.b", F.struct("doc_id", "tag", "w.line").alias("place"))
    )


def later_places(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows at any place but their first: ``doc_id, tag, line``."""
    rows = window_rows(texts, window)
    first = (
        rows.groupBy("a", "b")
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("a").alias("fa"), F.col("b").alias("fb"), "first")
    )
    found = rows.join(first, (rows["a"] == first["fa"]) & (rows["b"] == first["fb"]))
    return found.where("place > first").select("place.doc_id", "place.tag", "place.line")


def covered_lines(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document with removed lines: ``doc_id, tag, covered`` (line numbers, each once)."""
    cover = F.explode(F.sequence(F.col("line"), F.col("line") + (window - 1)))
    return (
        later_places(texts, window)
        .select("doc_id", "tag", cover.alias("line"))
        .groupBy("doc_id", "tag")
        .agg(F.collect_set("line").alias("covered"))
    )


def kept_text(text: Column, covered: Column) -> Column:
    """``text`` without its covered lines; the text itself if none is."""
    lines = lines_of(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    return F.when(covered.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text`` (what is kept), ``n_lines, n_removed``."""
    ready(docs.sparkSession)
    texts = keyed_text(docs)
    covered = covered_lines(texts, window)
    joined = texts.join(covered, same_row(texts, covered), "left")
    return joined.select(
        texts["doc_id"],
        kept_text(texts["text"], F.col("covered")).alias("text"),
        F.when(texts["text"].isNull(), 0).otherwise(F.size(lines_of(texts["text"]))).cast("long").alias("n_lines"),
        F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered")).cast("long").alias("n_removed"),
    )


def drop_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` and ``n_chars`` set anew.

    All columns stay. A document of which nothing is left goes; one that was empty before stays.
    """
    ready(docs.sparkSession)
    found = covered_lines(keyed_text(docs), window).select(
        F.col("doc_id").alias("_d"), F.col("tag").alias("_t"), F.col("covered").alias("_c")
    )
    left = docs.select(F.struct("*").alias("_row"), text_tag(docs["text"]).alias("_tag"))
    same = left["_row.doc_id"].cast("long").eqNullSafe(found["_d"]) & (left["_tag"] == found["_t"])
    text = kept_text(F.col("_row.text"), F.col("_c"))
    fresh = left.join(found, same, "left").select("_row", F.col("_c").isNotNull().alias("_cut"), text.alias("_text"))
    fresh = fresh.where(~F.col("_cut") | (F.trim(F.translate("_text", "\n\r\t", "   ")) != ""))
    old = {c: F.col("_row").getField(c) for c in docs.columns}
    new = {"text": F.col("_text"), "n_chars": F.when(F.col("_cut"), F.length("_text").cast("long"))}
    return fresh.select(*[F.coalesce(new[c], old[c]).alias(c) if c in new else old[c].alias(c) for c in docs.columns])
