"""Text lines and word counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hybridflow.functions.words import lines_of, paired_with_one, words_of
from hybridflow.operators.keyed import totals_by_key
from hybridflow.operators.rolling import Fold
from hybridflow.operators.windows import (
    fold_panes,
    panes,
    sliding_counts,
    trailing_counts,
    window_runs,
    windowed_fold,
)
from hybridflow.plans.elements import CUTS, event_batches
from hybridflow.session import new_path
from hybridflow.sources.queue import BatchQueue
from hybridflow.sources.tables import table
from hybridflow.sources.text import read_clean_lines, read_lines
from hybridflow.streaming.sinks import batch_folder, read_batches
from hybridflow.streaming.stateful import totals_updates


def _counted(lines):
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def src_text_lines(spark, folder):
    path = new_path(spark, "text")
    table(spark, folder, "documents").select("text").write.text(path)
    return _counted(read_lines(spark, path))


def text_lines_strip_cr(spark, folder):
    path = new_path(spark, "text")
    windows = F.concat(F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")), F.lit("\r"))
    table(spark, folder, "documents").select(windows).write.text(path)
    return _counted(read_clean_lines(spark, path))


def text_lines_delimited(spark, folder):
    """Lines with an end of their own, of two characters; newlines are text."""
    path, end = new_path(spark, "delimited"), "\x1e\n"
    lines = lines_of(table(spark, folder, "documents"), "text").select(F.concat("line", F.lit("\n.")))
    lines.write.option("lineSep", end).text(path)
    return _counted(read_clean_lines(spark, path, end))


def split_words(spark, folder):
    lines = lines_of(table(spark, folder, "documents"), "text", "doc_id")
    return words_of(lines, "line", "doc_id").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"), F.count_if(F.col("word") == "").alias("n_empty")
    )


def wordcount_total(spark, folder):
    words = words_of(lines_of(table(spark, folder, "documents"), "text"), "line")
    return totals_by_key(paired_with_one(words), ["word"], "one", "n")


def _event_words(rows):
    line = F.concat_ws(" ", "event_type", "props").alias("line")
    return words_of(rows.select("ts", line), "line", "ts")


def wordcount_sliding(spark, folder):
    counts = sliding_counts(_event_words(table(spark, folder, "events")), length=300, slide=60)
    return counts.select(F.unix_seconds("w_end").alias("w_end"), "word", "n")


def wordcount_sliding_stream(spark, folder):
    """Panes are counted in keyed state; a window is made of its panes' latest counts, open or closed."""
    out = new_path(spark, "sliding")
    batches = [b.select("ts", "event_type", "props") for b in event_batches(spark, folder, CUTS[1:2])]
    folds = [Fold("n", "count")]

    def sink(stream):
        paned = _event_words(stream).select("word", panes(F.col("ts"), 300, 60).alias("pane"))
        counted = totals_updates(paned, ["word", "pane"], folds)
        return counted.writeStream.outputMode("update").foreachBatch(batch_folder(out))

    BatchQueue(spark).run(batches, sink)
    latest = read_batches(spark, out).groupBy("word", "pane").agg(F.max_by("n", "batch_id").alias("n"))
    counts = fold_panes(latest, ["word"], folds, "pane", 300, 60)
    return counts.select(F.unix_seconds("w_end").alias("w_end"), "word", "n")


def wordcount_sliding_1s(spark, folder):
    """Words of the last 5 minutes at each second: in how many windows a word counts ``n``, and the largest
    value of an event in one of these. All windows are folded; equal counts are put together."""
    events = table(spark, folder, "events").select("ts", "value", F.concat_ws(" ", "event_type", "props").alias("line"))
    words = words_of(events, "line", "ts", "value")
    folds = [Fold("n", "count"), Fold("largest", "max", "value")]
    paned = words.groupBy("word", panes(F.col("ts"), 300, 1).alias("pane")).agg(*[f.over_rows().alias(f.name) for f in folds])
    runs = window_runs(paned, ["word"], folds, "pane", 300, 1)
    windows = F.sum(F.col("last_end") - F.col("first_end") + 1)
    return runs.groupBy("word", "n").agg(windows.alias("n_windows"), F.max("largest").alias("largest"))


def windowed_sum_by_key(spark, folder):
    """Values of each event type over the last 5 minutes, each minute and a half."""
    folds = [Fold("n", "count"), Fold("total", "sum", "value"), Fold("largest", "max", "value")]
    sums = windowed_fold(table(spark, folder, "events"), ["event_type"], folds, length=300, slide=90)
    return sums.select(F.unix_seconds("w_end").alias("w_end"), "event_type", "n", F.round("total", 4).alias("total"), "largest")


def wordcount_trailing(spark, folder):
    counts = trailing_counts(_event_words(table(spark, folder, "events")), length=300)
    return counts.select(F.unix_seconds("at").alias("at"), "word", "n")


QUERIES = {
    "src_text_lines": src_text_lines,
    "text_lines_strip_cr": text_lines_strip_cr,
    "text_lines_delimited": text_lines_delimited,
    "split_words": split_words,
    "wordcount_total": wordcount_total,
    "wordcount_sliding": wordcount_sliding,
    "wordcount_sliding_stream": wordcount_sliding_stream,
    "wordcount_sliding_1s": wordcount_sliding_1s,
    "wordcount_trailing": wordcount_trailing,
    "windowed_sum_by_key": windowed_sum_by_key,
}

_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"
_SPLIT = """CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                 ELSE string_split(rtrim(line, ' '), ' ') END"""
_EVENT_WORDS = """
    SELECT CAST(floor(epoch(ts)) AS BIGINT) AS s,
           unnest(string_split(event_type || ' ' || props, ' ')) AS word
    FROM events"""
_SLIDING = f"""
    SELECT (s // 60 + i) * 60 AS w_end, word, count(*) AS n
    FROM ({_EVENT_WORDS}) CROSS JOIN (SELECT unnest(range(1, 6)) AS i)
    GROUP BY 1, 2"""

SQL = {
    "src_text_lines": f"SELECT line AS value, count(*) AS n FROM ({_LINES}) GROUP BY line",
    "text_lines_strip_cr": f"SELECT line AS value, count(*) AS n FROM ({_LINES}) GROUP BY line",
    "text_lines_delimited": f"SELECT line || chr(10) || '.' AS value, count(*) AS n FROM ({_LINES}) GROUP BY line",
    "split_words": f"""
        SELECT doc_id, count(*) AS n_words, count(*) FILTER (word = '') AS n_empty
        FROM (SELECT doc_id, unnest({_SPLIT}) AS word FROM ({_LINES})) GROUP BY doc_id""",
    "wordcount_total": f"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest({_SPLIT}) AS word FROM ({_LINES})) GROUP BY word""",
    "wordcount_sliding": _SLIDING,
    "wordcount_sliding_stream": _SLIDING,
    "wordcount_sliding_1s": """
        SELECT word, n, count(*) AS n_windows, max(largest) AS largest
        FROM (SELECT word, s + i AS w_end, CAST(sum(n) AS BIGINT) AS n, max(largest) AS largest
              FROM (SELECT word, s, count(*) AS n, max(value) AS largest
                    FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS s, value,
                                 unnest(string_split(event_type || ' ' || props, ' ')) AS word FROM events)
                    GROUP BY word, s)
              CROSS JOIN (SELECT unnest(range(1, 301)) AS i)
              GROUP BY word, w_end)
        GROUP BY word, n""",
    "windowed_sum_by_key": """
        SELECT w_end, event_type, count(*) AS n, round(sum(value), 4) AS total, max(value) AS largest
        FROM (SELECT s, event_type, value, unnest(range((s // 90 + 1) * 90, s + 301, 90)) AS w_end
              FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS s, event_type, value FROM events))
        WHERE w_end - 300 <= s AND s < w_end GROUP BY 1, 2""",
    "wordcount_trailing": f"""
        SELECT s AS at, word, CAST(sum(n) OVER (PARTITION BY word ORDER BY s
               RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS BIGINT) AS n
        FROM (SELECT s, word, count(*) AS n FROM ({_EVENT_WORDS}) GROUP BY s, word)""",
}
