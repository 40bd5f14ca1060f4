"""Messages, lines as records and tagged unions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hybridflow.functions.records import (
    decode_csv,
    decode_json,
    encode_csv,
    encode_json,
    left_side,
    map_left,
    parse_lines,
    right_side,
)
from hybridflow.functions.table_functions import FlatMap, connected, register
from hybridflow.operators.connect import connect
from hybridflow.plans.elements import CUTS, event_batches
from hybridflow.session import new_path
from hybridflow.sources.queue import BatchQueue
from hybridflow.sources.tables import table
from hybridflow.sources.text import read_clean_lines
from hybridflow.streaming.sinks import batch_folder, read_batches
from hybridflow.streaming.stateful import co_map_stream

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def decode_messages(spark, folder):
    record = decode_json(F.encode("props", "utf-8"), "k INT")
    return table(spark, folder, "events").select("event_id", record["k"].alias("k"))


def encode_messages(spark, folder):
    message = encode_json(F.struct("event_id", "user_id", "event_type"))
    return table(spark, folder, "events").select("event_id", message.alias("message"))


def decode_csv_messages(spark, folder):
    message = F.encode(encode_csv(F.struct("event_id", "event_type", "user_id")), "utf-8")
    record = decode_csv(message, "event_id BIGINT, event_type STRING, user_id BIGINT")
    return table(spark, folder, "events").select(record.alias("r")).select("r.*")


def _customer_lines(spark, folder):
    return table(spark, folder, "customer").select(encode_csv(F.struct("*")).alias("value"))


def parsed_lines(spark, folder):
    """Customers as lines, some cut off in front; a line that does not parse stays in ``_corrupt``."""
    path = new_path(spark, "customer-lines")
    lines = _customer_lines(spark, folder)
    cut = table(spark, folder, "customer").where("c_nationkey = 3").select(F.concat(F.lit("cut off "), "c_name").alias("value"))
    lines.unionByName(cut).write.text(path)
    parsed = parse_lines(read_clean_lines(spark, path), "value", CUSTOMER)
    return parsed.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("c_custkey", "c_nationkey")})


def tagged_union_map(spark, folder):
    lines = _customer_lines(spark, folder).select(*left_side(F.col("value")))
    union = map_left(lines.unionByName(right_side(lines)), lambda v: F.from_csv(v, CUSTOMER))
    return union.select(
        "side",
        F.coalesce("value.c_custkey", F.lit(-1)).alias("c_custkey"),
        F.col("value.c_acctbal").alias("c_acctbal"),
    )


def connect_tagged_union(spark, folder):
    stream = table(spark, folder, "events").select(F.col("user_id").alias("k"), "value")
    batch = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    both = connect(stream, batch)
    return both.groupBy("k").agg(
        F.count_if(F.col("side") == "stream").alias("n_stream"),
        F.count_if(F.col("side") == "batch").alias("n_batch"),
        F.round(F.sum("value"), 4).alias("total"),
        F.max("c_acctbal").alias("balance"),
    )


def connect_co_map(spark, folder):
    """Each event with its user's market segment; events that come before their customer wait for it."""
    stream = [
        b.select(F.lit("stream").alias("side"), F.col("user_id").alias("k"), F.col("event_id").alias("value"))
        for b in event_batches(spark, folder, CUTS[1:2])
    ]
    batch = table(spark, folder, "customer").select(
        F.lit("batch").alias("side"), F.col("c_custkey").alias("k"),
        F.lit("segment").alias("name"), F.col("c_mktsegment").alias("text"),
    )
    out = new_path(spark, "co-map")
    no_text = {c: F.lit(None).cast("string") for c in ("name", "text")}
    early, later = (b.withColumns(no_text) for b in stream)
    later = later.unionByName(batch.withColumn("value", F.lit(None).cast("bigint")))
    kinds = (("k", LongType()), ("event_id", LongType()), ("segment", StringType()))
    schema = StructType([StructField(name, kind) for name, kind in kinds])

    def segments(key, event_ids, known):
        return pd.DataFrame({"k": key[0], "event_id": event_ids, "segment": known["segment"]})

    def sink(both):
        joined = co_map_stream(both, "k", segments, schema, salts=4)
        return joined.writeStream.foreachBatch(batch_folder(out))

    BatchQueue(spark).run([early, later], sink)
    return read_batches(spark, out).select("k", "event_id", "segment")


class SegmentOf(FlatMap):
    """Each event with the segment of its customer, who comes first in a partition if there is one."""

    def open(self):
        self.segment, self.seen = None, 0

    def flat_map(self, row):
        if row["side"] == 0:
            self.segment = row["c_mktsegment"]
        elif self.segment is not None:
            self.seen += 1
            yield row["k"], row["event_id"], self.segment


def udtf_co_flat_map(spark, folder):
    """A stateful flat map over connected inputs, as a table function in SQL."""
    stream = table(spark, folder, "events").select(F.col("user_id").alias("k"), "ts", "event_id")
    batch = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    connected(stream, batch, ["k"]).createOrReplaceTempView("hybridflow_connected")
    register(spark, "hybridflow_segment_of", SegmentOf, "k BIGINT, event_id BIGINT, segment STRING")
    return spark.sql("""
        SELECT k, event_id, segment
        FROM hybridflow_segment_of(TABLE(hybridflow_connected) PARTITION BY (k, salt) ORDER BY (side, ts, event_id))""")


QUERIES = {
    "decode_messages": decode_messages,
    "encode_messages": encode_messages,
    "decode_csv_messages": decode_csv_messages,
    "parse_lines": parsed_lines,
    "tagged_union_map": tagged_union_map,
    "connect_tagged_union": connect_tagged_union,
    "connect_co_map": connect_co_map,
    "udtf_co_flat_map": udtf_co_flat_map,
}

_SEGMENTS = """
    SELECT c_custkey AS k, event_id, c_mktsegment AS segment
    FROM events JOIN customer ON user_id = c_custkey"""

SQL = {
    "decode_messages": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "encode_messages": """
        SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id
               || ',"event_type":"' || event_type || '"}' AS message
        FROM events""",
    "decode_csv_messages": "SELECT event_id, event_type, user_id FROM events",
    "parse_lines": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS _corrupt
        FROM customer
        UNION ALL SELECT -1, NULL, -1, NULL, NULL, 'cut off ' || c_name FROM customer WHERE c_nationkey = 3""",
    "tagged_union_map": """
        SELECT 'left' AS side, c_custkey, c_acctbal FROM customer
        UNION ALL SELECT 'right', -1, NULL""",
    "connect_tagged_union": """
        SELECT k, count(*) FILTER (side = 'stream') AS n_stream,
               count(*) FILTER (side = 'batch') AS n_batch,
               round(sum(value), 4) AS total, max(c_acctbal) AS balance
        FROM (SELECT 'stream' AS side, user_id AS k, value, NULL AS c_acctbal FROM events
              UNION ALL SELECT 'batch', c_custkey, NULL, c_acctbal FROM customer)
        GROUP BY k""",
    "connect_co_map": _SEGMENTS,
    "udtf_co_flat_map": _SEGMENTS,
}
