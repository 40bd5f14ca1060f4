"""Hybrid joins: events or orders as the stream, customers or suppliers as the batch side."""

from __future__ import annotations

from pyspark.sql import functions as F

from hybridflow.operators.hybrid_join import enrich, full, one_per_key, snapshot
from hybridflow.operators.rolling import Fold
from hybridflow.plans.elements import CUTS, event_batches
from hybridflow.session import new_path
from hybridflow.sources.queue import BatchQueue
from hybridflow.sources.tables import table
from hybridflow.streaming.keyed_join import join_stream
from hybridflow.streaming.sinks import batch_folder, read_batches
from hybridflow.streaming.state import state_table
from hybridflow.streaming.stateful import totals_stream

COMPLETE_AT = "2024-01-15 00:00:00"
KEY = ["k"]
ORDER = ["ts", "event_id"]
FOLDS = [Fold("n", "count"), Fold("total", "sum", "value")]


def _event_rows(rows):
    return rows.select(F.col("user_id").alias("k"), "ts", "event_id", "value")


def _events(spark, folder):
    return _event_rows(table(spark, folder, "events"))


def _customers(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )


def _suppliers(spark, folder):
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance")
    )


def _shown(df, *columns):
    """Result columns; a flushed entry has no event, shown as -1."""
    if "phase" in columns:
        df = df.withColumn("event_id", F.coalesce("event_id", F.lit(-1)))
    return df.select(*columns, "k", "n", F.round("total", 4).alias("total"), "balance")


def hybrid_join_enrich(spark, folder):
    joined = enrich(_events(spark, folder), _customers(spark, folder), KEY, ORDER, FOLDS)
    return _shown(joined, "event_id", "c_mktsegment")


def hybrid_join_enrich_suppliers(spark, folder):
    joined = enrich(_events(spark, folder), _suppliers(spark, folder), KEY, ORDER, FOLDS)
    return _shown(joined, "event_id")


def hybrid_join_enrich_orders(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey", "o_totalprice"
    )
    folds = [Fold("n", "count"), Fold("total", "sum", "o_totalprice"), Fold("largest", "max", "o_totalprice")]
    joined = enrich(orders, _customers(spark, folder), KEY, ["o_orderdate", "o_orderkey"], folds)
    return _shown(joined, "o_orderkey", "largest")


def hybrid_join_snapshot(spark, folder):
    return _shown(snapshot(_events(spark, folder), _customers(spark, folder), KEY, FOLDS))


def hybrid_join_snapshot_suppliers(spark, folder):
    return _shown(snapshot(_events(spark, folder), _suppliers(spark, folder), KEY, FOLDS))


def hybrid_join_repeated_side(spark, folder):
    """The batch side has many rows per key: each supplier's latest line item."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("k"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("at"),
        F.col("l_extendedprice").alias("balance"),
    )
    side = one_per_key(lines, KEY, ["balance"], latest_by="at")
    return _shown(snapshot(_events(spark, folder), side, KEY, FOLDS))


def _full(spark, folder, batch):
    joined = full(_events(spark, folder), batch, KEY, ORDER, FOLDS, COMPLETE_AT)
    return _shown(joined, "phase", "event_id")


def hybrid_join_full(spark, folder):
    return _full(spark, folder, _customers(spark, folder))


def hybrid_join_full_suppliers(spark, folder):
    return _full(spark, folder, _suppliers(spark, folder))


def _joined(spark, batches, label, *args, **kwargs):
    """All rows that :func:`join_stream` gives for a queue of micro-batches."""
    out = new_path(spark, label)

    def sink(stream):
        return join_stream(stream, KEY, ORDER, FOLDS, *args, **kwargs).writeStream.foreachBatch(batch_folder(out))

    BatchQueue(spark).run(batches, sink)
    return read_batches(spark, out)


def hybrid_join_enrich_stream(spark, folder):
    batches = [_event_rows(b) for b in event_batches(spark, folder)]
    return _shown(_joined(spark, batches, "enriched", _customers(spark, folder)), "event_id", "c_mktsegment")


def hybrid_join_snapshot_stream(spark, folder):
    """The entries that the keyed state holds once the stream has ended, read from the state alone."""
    batches = [_event_rows(b) for b in event_batches(spark, folder, CUTS[1:2])]
    side, queue = _suppliers(spark, folder), BatchQueue(spark)
    queue.run(batches, lambda stream: totals_stream(stream, KEY, FOLDS, side).writeStream.format("noop"))
    entries = state_table(spark, queue.checkpoint, "entry")
    return _shown(entries.withColumn("n", F.coalesce("n", F.lit(0))))


def hybrid_join_full_stream(spark, folder):
    """All events go through the stream. Entries come out by their timers once the watermark passes completion."""
    batches = [_event_rows(b) for b in event_batches(spark, folder, CUTS[1:])]
    return _shown(_joined(spark, batches, "full", _suppliers(spark, folder), complete_at=COMPLETE_AT), "phase", "event_id")


QUERIES = {
    "hybrid_join_enrich": hybrid_join_enrich,
    "hybrid_join_enrich_suppliers": hybrid_join_enrich_suppliers,
    "hybrid_join_enrich_orders": hybrid_join_enrich_orders,
    "hybrid_join_enrich_stream": hybrid_join_enrich_stream,
    "hybrid_join_full": hybrid_join_full,
    "hybrid_join_full_suppliers": hybrid_join_full_suppliers,
    "hybrid_join_full_stream": hybrid_join_full_stream,
    "hybrid_join_snapshot": hybrid_join_snapshot,
    "hybrid_join_snapshot_suppliers": hybrid_join_snapshot_suppliers,
    "hybrid_join_snapshot_stream": hybrid_join_snapshot_stream,
    "hybrid_join_repeated_side": hybrid_join_repeated_side,
}

_RUNNING = """
    SELECT user_id AS k, ts, event_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"""
_CUSTOMERS = "SELECT c_custkey AS k, c_acctbal AS balance, c_mktsegment FROM customer"
_SUPPLIERS = "SELECT s_suppkey AS k, s_acctbal AS balance FROM supplier"
_LATEST_LINES = """
    SELECT l_suppkey AS k, arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber)) AS balance
    FROM lineitem GROUP BY l_suppkey"""


def _enrich_sql(batch: str, *columns: str) -> str:
    shown = ", ".join(["event_id", *columns])
    return f"SELECT {shown}, k, n, total, balance FROM ({_RUNNING}) LEFT JOIN ({batch}) USING (k)"


def _snapshot_sql(batch: str, where: str = "TRUE") -> str:
    return f"""
        SELECT k, coalesce(n, 0) AS n, total, balance
        FROM (SELECT user_id AS k, count(*) AS n, round(sum(value), 4) AS total
              FROM events WHERE {where} GROUP BY user_id)
        FULL JOIN ({batch}) USING (k)"""


def _full_sql(batch: str) -> str:
    at = "TIMESTAMP '2024-01-15 00:00:00'"
    return f"""
        SELECT 'flush' AS phase, CAST(-1 AS BIGINT) AS event_id, k, n, total, balance
        FROM ({_snapshot_sql(batch, f'ts < {at}')})
        UNION ALL
        SELECT 'stream', event_id, k, n, total, balance
        FROM ({_RUNNING}) LEFT JOIN ({batch}) USING (k) WHERE ts >= {at}"""


SQL = {
    "hybrid_join_enrich": _enrich_sql(_CUSTOMERS, "c_mktsegment"),
    "hybrid_join_enrich_suppliers": _enrich_sql(_SUPPLIERS),
    "hybrid_join_enrich_orders": f"""
        SELECT o_orderkey, max(o_totalprice) OVER w AS largest, o_custkey AS k,
               count(*) OVER w AS n, round(sum(o_totalprice) OVER w, 4) AS total, balance
        FROM orders LEFT JOIN ({_CUSTOMERS}) ON o_custkey = k
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
    "hybrid_join_enrich_stream": _enrich_sql(_CUSTOMERS, "c_mktsegment"),
    "hybrid_join_full": _full_sql(_CUSTOMERS),
    "hybrid_join_full_suppliers": _full_sql(_SUPPLIERS),
    "hybrid_join_full_stream": _full_sql(_SUPPLIERS),
    "hybrid_join_snapshot": _snapshot_sql(_CUSTOMERS),
    "hybrid_join_snapshot_suppliers": _snapshot_sql(_SUPPLIERS),
    "hybrid_join_snapshot_stream": _snapshot_sql(_SUPPLIERS),
    "hybrid_join_repeated_side": _snapshot_sql(_LATEST_LINES),
}
