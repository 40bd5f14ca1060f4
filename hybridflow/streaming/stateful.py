"""Operators of an unbounded stream in keyed state; only keys that occur are touched.

``totals_updates`` emits a key's totals per micro-batch out of Spark's own aggregation, in output mode "update".
``totals_stream`` does so in any mode and with a batch side, out of entries that can be read from the state; an
entry costs a message or two. Both combine rows before they meet, so they take any distribution of keys. A row per
row gives ``hybridflow.streaming.keyed_join``.
``co_map_stream`` connects two inputs by user functions with shared state.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from hybridflow.functions.python_udf import KEYS_HELD
from hybridflow.operators.hybrid_join import known_keys
from hybridflow.operators.rolling import Fold
from hybridflow.session import use_rocksdb_state
from hybridflow.streaming.keyed_join import READ_ALONE, EntryProcessor, merged

#: Groups that the rows of one key are dealt into, and waiting values answered at a time.
SALTS = 8
WAITING_PART = 10_000
#: Groups of keys in the state; like the number of state partitions it is fixed when a query first starts.
BUCKETS = 256


def _entry_schema(stream, key, folds, side) -> tuple[StructType, StructType]:
    """Types of a key's totals and of its attributes."""
    names = {f.name for f in folds}
    attributes = [] if side is None else [c for c in side.columns if c not in key and c not in names]
    return (
        StructType([StructField(f.name, f.result_type(stream.schema), True) for f in folds]),
        StructType([StructField(c, side.schema[c].dataType, True) for c in attributes]),
    )


class TotalsProcessor(EntryProcessor):
    """Keeps an entry per key of a bucket, merges partial totals into it and emits it once."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kinds, added = ["sum" if f.kind == "count" else f.kind for f in self.folds], {}
        for row in rows:
            k, totals = tuple(row[c] for c in self.key.names), [row[f.name] for f in self.folds]
            held = added.get(k, [None] * len(kinds))
            added[k] = [merged(kind, a, b) for kind, a, b in zip(kinds, held, totals, strict=True)]
        held = self._entries(dict.fromkeys(added))
        shown = Row(*self.key.names, *self.state.names)
        for k, totals in added.items():
            old = held.get(k, self.nothing)
            new = [merged(kind, a, b) for kind, a, b in zip(kinds, old, totals, strict=False)]
            held[k] = (*new, *old[len(kinds) :])
            yield shown(*k, *held[k])
        self._store(held)


def _partial_totals(key: list[str], folds: list[Fold]):
    """Totals of the rows a task reads, passed on in portions of a bounded number of keys."""
    kinds = {f.name: "sum" if f.kind == "count" else f.kind for f in folds}

    def combine(rows: pa.Table) -> pa.Table:
        totals = rows.group_by(key, use_threads=False).aggregate(list(kinds.items()))
        named = totals.select([*key, *[f"{n}_{k}" for n, k in kinds.items()]])
        return named.rename_columns(rows.schema.names).cast(rows.schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = combine(rows if held is None else pa.concat_tables([held, rows]))
            if held.num_rows >= KEYS_HELD:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    return partial


def totals_stream(
    stream: DataFrame, key: list[str], folds: list[Fold], side: DataFrame | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Per key and micro-batch it occurs in: the key's totals so far and its attributes.

    Rows are combined in the task that reads them, so what meets at a key is a few partial
    totals per task. ``side`` is loaded once into the state; rows that repeat a key are folded to one.
    Keys are put into ``buckets``, fixed when a query first starts.
    """
    use_rocksdb_state(stream.sparkSession)
    side = None if side is None else known_keys(side, key)  # a null key finds no attributes
    columns = [
        (F.lit(1) if f.kind == "count" else F.col(f.column)).cast(f.result_type(stream.schema)).alias(f.name)
        for f in folds
    ]
    rows = stream.select(*key, *columns)
    partials = rows.mapInArrow(_partial_totals(key, folds), rows.schema)
    totals, extra = _entry_schema(stream, key, folds, side)
    keys = StructType([StructField(k, stream.schema[k].dataType, True) for k in key])
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    if side is not None:
        side = side.withColumns({k: F.col(k).cast(stream.schema[k].dataType) for k in key})
        side = side.withColumn("_bucket", bucket).groupBy("_bucket")
    return partials.withColumn("_bucket", bucket).groupBy("_bucket").transformWithState(
        statefulProcessor=TotalsProcessor(keys, folds, totals, extra, None),
        outputStructType=StructType([*keys.fields, *totals.fields, *extra.fields]),
        outputMode="Append",
        timeMode="None",
        initialState=side,
    )


def totals_updates(stream: DataFrame, key: list[str], folds: list[Fold]) -> DataFrame:
    """Per key and micro-batch it occurs in: the key's totals so far. Write it in output mode "update".

    The state is Spark's own, so keys may be many more than :func:`totals_stream` is good for.
    """
    use_rocksdb_state(stream.sparkSession)
    kinds = {f.name: f.result_type(stream.schema) for f in folds}
    return stream.groupBy(*key).agg(*[f.over_rows().cast(kinds[f.name]).alias(f.name) for f in folds])


class BufferedJoinProcessor(StatefulProcessor):
    """Two connected inputs with shared keyed state: stream rows wait for their key's batch rows.

    A group is a bucket of keys. Its list state holds the values that wait, however many, each with its key; its
    map state the batch side's values by key and name. ``fn((key,), values, attributes)`` makes rows of a series
    of one key's stream values.
    """

    def __init__(self, fn: Callable, key: StructField, value: StructField):
        self.fn = fn
        self.key = key
        self.value = value

    def init(self, handle: StatefulProcessorHandle) -> None:
        name, text = StructField("name", StringType(), True), StructField("text", StringType(), True)
        told = StructType([StructField("names", ArrayType(StringType()), True), StructField("size", LongType(), True)])
        self.waiting = handle.getListState("waiting", StructType([self.key, self.value]))
        self.attributes = handle.getMapState("attributes", StructType([self.key, name]), StructType([text]))
        self.told = handle.getValueState("told", told)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A bucket's rows come in no order, so batch rows are taken in before stream rows are answered.
        # Every call on a state is a message, so none is made that cannot matter.
        new, arrived, values = {}, {}, []
        for part in rows:
            batch = part["side"] == "batch"
            for k, shown, name, text in part.loc[batch, ["matched", "shown", "name", "text"]].itertuples(index=False):
                new[k, name] = text
                arrived[k] = shown
            values.append(part.loc[~batch, ["matched", "shown", "value", "given"]])
        values = pd.concat(values, ignore_index=True)
        waits = bool(arrived) and self.waiting.exists()
        known = self._known({*values["matched"].tolist(), *(arrived if waits else ())}, new)
        frames, size = [], 0
        for frame in itertools.chain(self._waited(known, arrived) if waits else (), self._answers(known, values)):
            frames.append(frame)
            size += len(frame)
            if size >= WAITING_PART:
                yield pd.concat(frames, ignore_index=True)
                frames, size = [], 0
        if frames:
            yield pd.concat(frames, ignore_index=True)
        self._wait(values[~values["matched"].isin(list(known))])

    def _known(self, keys: set, new: dict) -> dict:
        """Values by name of those of the keys that have any, once the ``new`` ones are in the state.

        Entries are read by key and name, or all of the bucket's if these are not many more. ``told`` has the names
        that occur and the number of entries.
        """
        names, size = self.told.get() or ([], 0)
        whole = READ_ALONE * len(keys) * len(names) >= size
        if whole:
            held = {tuple(at): text[0] for at, text in self.attributes.iterator()} if size else {}
            found = {at: text for at, text in held.items() if at[0] in keys}
        else:
            read = (((k, name), self.attributes.getValue((k, name))) for k in keys for name in names)
            found = {at: text[0] for at, text in read if text is not None}
        for at, text in new.items():
            size += not (at in held if whole else at in found or self.attributes.containsKey(at))
            self.attributes.updateValue(at, (text,))
        if new:
            self.told.update((sorted({*names, *(name for _, name in new)}, key=str), size))
        known = {}
        for (k, name), text in [*found.items(), *((at, text) for at, text in new.items() if at[0] in keys)]:
            known.setdefault(k, {})[name] = text
        return known

    def _waited(self, known: dict, arrived: dict) -> Iterator[pd.DataFrame]:
        """Answers to the values that waited for the keys that have arrived; the others go on waiting."""
        held, left, n = {}, [], 0
        for k, value in self.waiting.get():
            if k not in arrived:
                left.append((k, value))
                continue
            held.setdefault(k, []).append(value)
            n += 1
            if n == WAITING_PART:
                yield from (self.fn((arrived[k],), pd.Series(part), known[k]) for k, part in held.items())
                held, n = {}, 0
        yield from (self.fn((arrived[k],), pd.Series(part), known[k]) for k, part in held.items())
        self.waiting.clear()
        self._append(left)

    def _answers(self, known: dict, values: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for k, part in values[values["matched"].isin(list(known))].groupby("matched", sort=False):
            given = part["value"] if part["given"].all() else part["value"].where(part["given"])
            yield self.fn((part["shown"].tolist()[0],), given.reset_index(drop=True), known[k])

    def _wait(self, values: pd.DataFrame) -> None:
        rows = zip(*[values[c].tolist() for c in ("matched", "value", "given")], strict=True)
        self._append([(k, v if given else None) for k, v, given in rows])

    def _append(self, waiting: list[tuple]) -> None:
        for at in range(0, len(waiting), WAITING_PART):
            self.waiting.appendList(waiting[at : at + WAITING_PART])

    def close(self) -> None:
        pass


def co_map_stream(
    both: DataFrame, key: str, fn: Callable, schema: StructType, salts: int = SALTS, buckets: int = BUCKETS
) -> DataFrame:
    """``fn`` over a connected stream and batch side that share state by key.

    ``both`` has ``side`` ("stream" or "batch"), the key, a stream row's ``value``, and a batch
    row's ``name`` and ``text``. A stream row gives its rows once a batch row of its key has come,
    in this micro-batch or a later one; it waits in the state until then. A null key meets nothing, so
    its rows are left out. ``fn((key,), values, attributes)`` gets series of values and returns a frame.

    Each key has ``salts`` states of its own: batch rows go to all of them, stream rows
    are dealt among them, so a key that holds most of a stream is the work of ``salts`` tasks. The
    batch side is held as often. Keys are put into ``buckets`` for each salt, fixed when a query first starts: a
    group costs a dozen messages to the state however many keys it has, an entry of the batch side one.
    Values that wait are read again when a batch row comes to their bucket.
    """
    use_rocksdb_state(both.sparkSession)
    kind, value = both.schema[key].dataType, both.schema["value"].dataType
    # Keys are compared in Python; those that could differ there from what Spark calls equal are compared as text.
    plain = isinstance(kind, (IntegralType, StringType, DateType, BooleanType))
    same = F.col(key)
    if isinstance(kind, BinaryType):
        same = F.hex(key)
    elif isinstance(kind, (FloatType, DoubleType)):
        same = (F.col(key) + F.lit(0.0).cast(kind)).cast("string")  # 0.0 and -0.0 are one
    elif not plain:
        same = F.col(key).cast("string")
    # A null would make pandas read whole numbers as floats. (Names of columns have no underscore in front, frames lose these.)
    filled = isinstance(value, (IntegralType, BooleanType))
    given = F.coalesce("value", F.lit(0).cast(value)) if filled else F.col("value")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    one = F.array(F.floor(F.rand(0) * salts).cast("int"))
    salted = both.where(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(same), F.lit(buckets)).cast("int").alias("_bucket"),
        F.explode(F.when(F.col("side") == "batch", every).otherwise(one)).alias("_salt"),
        "side", same.alias("matched"), F.col(key).alias("shown"),
        given.alias("value"), F.col("value").isNotNull().alias("given"), "name", "text",
    )
    return salted.groupBy("_bucket", "_salt").transformWithStateInPandas(
        statefulProcessor=BufferedJoinProcessor(
            fn, StructField(key, kind if plain else StringType(), True), StructField("value", value, True)
        ),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
    )
