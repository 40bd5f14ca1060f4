"""Element-wise functions, keying, reducing and sinks, over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.functions import python_udf
from hybridflow.functions.records import parity
from hybridflow.operators.keyed import (
    key_by,
    random_spread,
    totals_by_key,
    totals_per_batch,
)
from hybridflow.operators.rolling import Fold, rolling_fold, with_values
from hybridflow.session import new_path
from hybridflow.sources.queue import BatchQueue, split_at
from hybridflow.sources.tables import inline_elements, table
from hybridflow.streaming.keyed_join import join_stream
from hybridflow.streaming.sinks import batch_folder, first_rows, per_batch_totals, read_batches
from hybridflow.streaming.transactional import read_committed, register_sink

# Where the event table is cut into micro-batches.
CUTS = ["2024-01-08", "2024-01-15", "2024-01-22"]

WEIGHTS = [("click", 1), ("view", 2), ("signup", 3), ("purchase", 4)]


def event_batches(spark: SparkSession, folder: str, cuts: list[str] = CUTS) -> list[DataFrame]:
    """The whole event table in runs of time. The cuts are on ``ts`` as stored, so that the
    scan can use them; a stream wants it with a zone."""
    runs = split_at(table(spark, folder, "events"), "ts", cuts)
    return [run.withColumn("ts", F.col("ts").cast("timestamp")) for run in runs]


def numbers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(F.col("event_id").alias("value"))


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return numbers(spark, folder).select(parity(F.col("value")).alias("key"), "value")


def src_inline_elements(spark, folder):
    weights = inline_elements(spark, WEIGHTS, "event_type STRING, weight INT")
    joined = table(spark, folder, "events").join(weights, "event_type", "left")
    return joined.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")
    )


def map_double(spark, folder):
    return numbers(spark, folder).select((F.col("value") * 2).alias("value"))


def flatmap_explode(spark, folder):
    doubled = F.array(F.col("value") * 2)
    return numbers(spark, folder).select(F.explode(doubled).alias("value"))


def filter_not_equal(spark, folder):
    return numbers(spark, folder).where(F.col("value") != 3)


def keyed_partitions(spark, folder):
    keyed = key_by(table(spark, folder, "events").select("user_id", "event_id"), ["user_id"], "event_id", shares=4)
    return keyed.groupBy("user_id", "share", F.spark_partition_id().alias("p")).count().groupBy(
        "user_id"
    ).agg(F.sum("count").alias("n"), (F.count("p") == F.countDistinct("share")).alias("together"))


def spread(spark, folder):
    return random_spread(numbers(spark, folder), int(spark.conf.get("spark.sql.shuffle.partitions")))


def udf_map(spark, folder):
    double = python_udf.map_values(lambda values: values * 2, "bigint")
    return numbers(spark, folder).select("value", double(F.col("value")).alias("doubled"))


def udf_flat_map(spark, folder):
    words = python_udf.flat_map_values(lambda line: line.split(" "), "string")
    return table(spark, folder, "events").select(words(F.col("props")).alias("word"))


def udf_filter(spark, folder):
    wanted = python_udf.filter_values(lambda kinds: kinds != "error")
    return table(spark, folder, "events").where(wanted(F.col("event_type"))).select("event_id", "event_type")


def udf_group_reduce(spark, folder):
    return python_udf.reduce_by_key(pairs(spark, folder), "key", "value", lambda a, b: a + b)


def reduce_rolling(spark, folder):
    folds = [Fold("total", "sum", "value")]
    return rolling_fold(pairs(spark, folder), ["key"], ["value"], folds)


def reduce_rolling_by_user(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "ts", "event_id", "value")
    folds = [Fold("total", "sum", "value"), Fold("n", "count")]
    rolled = rolling_fold(rows, ["user_id"], ["ts", "event_id"], folds)
    return rolled.select("user_id", "event_id", "n", F.round("total", 4).alias("total"))


def reduce_rolling_stream(spark, folder):
    folds, out = [Fold("total", "sum", "value")], new_path(spark, "rolling")

    def sink(stream):
        # Of two keys each holds half of the stream, so slices are an hour.
        rolled = join_stream(stream, ["key"], ["ts", "value"], folds, slice_width=3_600)
        return rolled.writeStream.foreachBatch(batch_folder(out))

    BatchQueue(spark).run(_pair_batches(spark, folder), sink)
    return read_batches(spark, out).select("key", "value", "total")


def _purchases(rows):
    """Events with the value of a purchase; null for events of other kinds."""
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return rows.select(F.col("user_id").alias("key"), "ts", "event_id", bought.alias("bought"))


LAST_FOLDS = [Fold("n", "count"), Fold("latest", "last", "bought", ("ts", "event_id"))]


def reduce_rolling_last(spark, folder):
    """The value of each user's latest purchase, at every event."""
    rolled = rolling_fold(_purchases(table(spark, folder, "events")), ["key"], ["ts", "event_id"], LAST_FOLDS)
    return with_values(rolled, LAST_FOLDS).select("key", "event_id", "n", "latest")


def reduce_rolling_last_stream(spark, folder):
    out = new_path(spark, "rolling-last")

    def sink(stream):
        rolled = join_stream(stream, ["key"], ["ts", "event_id"], LAST_FOLDS)
        return with_values(rolled, LAST_FOLDS).writeStream.foreachBatch(batch_folder(out))

    BatchQueue(spark).run([_purchases(b) for b in event_batches(spark, folder)], sink)
    return read_batches(spark, out).select("key", "event_id", "n", "latest")


def _pair_batches(spark, folder):
    pair = [parity(F.col("event_id")).alias("key"), F.col("event_id").alias("value")]
    return [b.select("ts", *pair) for b in event_batches(spark, folder)]


def reduce_by_key_total(spark, folder):
    return totals_by_key(pairs(spark, folder), ["key"], "value")


def reduce_per_batch(spark, folder):
    rows = table(spark, folder, "events").select(
        "ts", parity(F.col("event_id")).alias("key"), F.col("event_id").alias("value")
    )
    return totals_per_batch(rows, F.date_format("ts", "yyyy-MM-dd"), ["key"], "value")


def reduce_per_batch_stream(spark, folder):
    out = new_path(spark, "per-batch")
    write = batch_folder(out, per_batch_totals(["key"], "value"))
    BatchQueue(spark).run(_pair_batches(spark, folder), lambda s: s.writeStream.foreachBatch(write))
    return read_batches(spark, out).select(F.col("batch_id").cast("bigint"), "key", "total")


def src_micro_batches(spark, folder):
    batches = [b.select("ts", "event_id") for b in event_batches(spark, folder)]
    out = new_path(spark, "micro-batches")
    write = batch_folder(out, lambda batch, _: batch.agg(F.count(F.lit(1)).alias("n")))
    BatchQueue(spark).run(batches, lambda s: s.writeStream.foreachBatch(write))
    return read_batches(spark, out).select(F.col("batch_id").cast("bigint"), "n")


def sink_foreach_batch(spark, folder):
    batches = [b.select("ts", "event_id", "user_id") for b in event_batches(spark, folder)]
    out = new_path(spark, "sink")
    write = batch_folder(out)
    BatchQueue(spark).run(batches, lambda s: s.writeStream.foreachBatch(write))
    return read_batches(spark, out).select(
        F.col("batch_id").cast("bigint"), "event_id", "user_id"
    )


def sink_transactional(spark, folder):
    """Micro-batches through a sink with commits; what counts is what their manifests name."""
    register_sink(spark)
    batches = [b.select("ts", "event_id", "user_id") for b in event_batches(spark, folder)]
    out = new_path(spark, "transactional")
    BatchQueue(spark).run(batches, lambda s: s.writeStream.format("transactional").option("path", out))
    return read_committed(spark, out, batches[0].schema).select("event_id", "user_id")


def sink_first_10(spark, folder):
    return first_rows(table(spark, folder, "events").select("event_id", "event_type"), ["event_id"])


QUERIES = {
    "src_inline_elements": src_inline_elements,
    "src_micro_batches": src_micro_batches,
    "map_double": map_double,
    "flatmap_explode": flatmap_explode,
    "filter_not_equal": filter_not_equal,
    "map_to_pair_parity": pairs,
    "key_by": keyed_partitions,
    "random_spread": spread,
    "udf_map": udf_map,
    "udf_flat_map": udf_flat_map,
    "udf_filter": udf_filter,
    "udf_group_reduce": udf_group_reduce,
    "reduce_rolling": reduce_rolling,
    "reduce_rolling_by_user": reduce_rolling_by_user,
    "reduce_rolling_stream": reduce_rolling_stream,
    "reduce_rolling_last": reduce_rolling_last,
    "reduce_rolling_last_stream": reduce_rolling_last_stream,
    "reduce_by_key_total": reduce_by_key_total,
    "reduce_per_batch": reduce_per_batch,
    "reduce_per_batch_stream": reduce_per_batch_stream,
    "sink_first_10": sink_first_10,
    "sink_foreach_batch": sink_foreach_batch,
    "sink_transactional": sink_transactional,
}

_KEYED = "SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS key, event_id AS value, ts FROM events"
_BATCH_ID = """CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 0 WHEN ts < TIMESTAMP '2024-01-15' THEN 1
                    WHEN ts < TIMESTAMP '2024-01-22' THEN 2 ELSE 3 END::BIGINT"""
_ROLLING = f"""
    SELECT key, value, CAST(sum(value) OVER (PARTITION BY key ORDER BY {{order}}
           ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
    FROM ({_KEYED})"""
_LAST = """
    SELECT user_id AS key, event_id, count(*) OVER w AS n,
           last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS latest
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""

SQL = {
    "src_inline_elements": """
        SELECT event_type, count(*) AS n, CAST(coalesce(sum(weight), 0) AS BIGINT) AS weight
        FROM events LEFT JOIN (VALUES ('click', 1), ('view', 2), ('signup', 3), ('purchase', 4))
             AS w(event_type, weight) USING (event_type)
        GROUP BY event_type""",
    "src_micro_batches": f"SELECT {_BATCH_ID} AS batch_id, count(*) AS n FROM events GROUP BY 1",
    "map_double": "SELECT event_id * 2 AS value FROM events",
    "flatmap_explode": "SELECT unnest([event_id * 2]) AS value FROM events",
    "filter_not_equal": "SELECT event_id AS value FROM events WHERE event_id <> 3",
    "map_to_pair_parity": f"SELECT key, value FROM ({_KEYED})",
    "key_by": "SELECT user_id, count(*) AS n, TRUE AS together FROM events GROUP BY user_id",
    "random_spread": "SELECT event_id AS value FROM events",
    "udf_map": "SELECT event_id AS value, event_id * 2 AS doubled FROM events",
    "udf_flat_map": "SELECT unnest(string_split(props, ' ')) AS word FROM events",
    "udf_filter": "SELECT event_id, event_type FROM events WHERE event_type <> 'error'",
    "udf_group_reduce": f"SELECT key, CAST(sum(value) AS BIGINT) AS value FROM ({_KEYED}) GROUP BY key",
    "reduce_rolling": _ROLLING.format(order="value"),
    "reduce_rolling_by_user": """
        SELECT user_id, event_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total
        FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "reduce_rolling_stream": _ROLLING.format(order="ts, value"),
    "reduce_rolling_last": _LAST,
    "reduce_rolling_last_stream": _LAST,
    "reduce_by_key_total": f"SELECT key, CAST(sum(value) AS BIGINT) AS total FROM ({_KEYED}) GROUP BY key",
    "reduce_per_batch": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS batch, key, CAST(sum(value) AS BIGINT) AS total
        FROM ({_KEYED}) GROUP BY 1, 2""",
    "reduce_per_batch_stream": f"""
        SELECT {_BATCH_ID} AS batch_id, key, CAST(sum(value) AS BIGINT) AS total
        FROM ({_KEYED}) GROUP BY 1, 2""",
    "sink_first_10": "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 10",
    "sink_transactional": "SELECT event_id, user_id FROM events",
    "sink_foreach_batch": f"SELECT {_BATCH_ID} AS batch_id, event_id, user_id FROM events",
}
