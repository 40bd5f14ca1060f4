"""Running folds and joins of a stream in keyed state, a row per row, with timers.

A micro-batch's rows are first brought together by bucket of keys and slice of their order. Each such part
is sorted and folded by its own task, all its keys at once, as Arrow arrays. What the keyed state then gets is
one row per part: the totals of its keys. The state keeps an entry per key. It merges the parts' totals in
order, and tells for each part the totals its keys had before. These meet the part's rows, which are brought
together once more and never pass through the state, and their running folds go on from there. So sorting and
folding the rows of a key that holds a third of a stream is spread over its slices, and the state's own work
and memory grow with keys and slices and not with rows.

The entries of a bucket are one map state, read and written by key; a bucket has a timer. They are in the
checkpoint of the query; :func:`hybridflow.streaming.state.state_table` reads them as a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from hybridflow.operators.hybrid_join import known_keys
from hybridflow.operators.rolling import Fold, _as_number
from hybridflow.session import use_rocksdb_state

#: Width of a slice, in seconds for times and in units for numbers.
SLICE_WIDTH = 86_400
#: Groups of keys in the state; like the number of state partitions it is fixed when a query first starts.
BUCKETS = 128
#: A part: the rows of a micro-batch that are folded together.
PART = ["_bucket", "_after", "_slice"]
#: Entries in one row on their way out of the state.
ENTRIES_PER_ROW = 10_000
#: Entries are read one by one if the bucket holds so many times more.
READ_ALONE = 20
MICROS = 1_000_000


def _in_order(value) -> tuple:
    """Sorting key: null first, not-a-number last, as Spark compares."""
    if isinstance(value, tuple):
        return tuple(_in_order(v) for v in value)
    return (0,) if value is None else (1, value != value, value)


def merged(kind: str, a, b):
    """Of two totals either may be None, meaning no rows."""
    if a is None or b is None:
        return b if a is None else a
    if kind in ("count", "sum"):
        return a + b
    return min(a, b, key=_in_order) if kind == "min" else max(a, b, key=_in_order)


def _plain(values: pa.Array | pa.ChunkedArray) -> list:
    """Python values; a struct is a tuple."""
    held = values.to_pylist()
    return [None if v is None else tuple(v.values()) for v in held] if pa.types.is_struct(values.type) else held


def _arrow(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_struct(kind):
        names = [kind.field(i).name for i in range(kind.num_fields)]
        values = [None if v is None else dict(zip(names, v, strict=True)) for v in values]
    return pa.array(values, kind)


def _whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _has_nan(values: pa.Array) -> bool:
    return pa.types.is_floating(values.type) and bool(pc.any(pc.is_nan(values)).as_py())


def running(kind: str, values: pa.Array, code: np.ndarray, result: pa.DataType) -> pa.Array:
    """Fold of each value and those before it under its key; rows lie together by key, whose numbers count from 0.

    None before a key's first value that is not null.
    """
    n = len(values)
    if not n:
        return pa.array([], result)
    first = np.flatnonzero(np.diff(code, prepend=-1))[code]
    if kind == "count":
        return pa.array(np.arange(n) - first + 1, result)
    known = np.asarray(values.is_valid())
    seen = np.maximum.accumulate(np.where(known, np.arange(n), -1))
    none = seen < first
    if kind == "last":
        return values.take(pa.array(seen, mask=none))
    whole = pa.types.is_integer(values.type)
    if kind == "sum" and whole:
        x = np.where(known, values.cast(pa.int64()).fill_null(0).to_numpy(), 0)
        sums = np.cumsum(x)
        return pa.array(sums - (sums - x)[first], pa.int64(), mask=none).cast(result)
    number = whole or pa.types.is_date(values.type) or pa.types.is_timestamp(values.type)
    if (number or pa.types.is_floating(values.type)) and not _has_nan(values):
        x = values
        if number:
            x = (x.cast(pa.int32()) if pa.types.is_date32(x.type) else x).cast(pa.int64())
        blank = 0 if kind == "sum" else (np.iinfo(np.int64) if number else np.finfo(np.float64))
        blank = blank if kind == "sum" else blank.max if kind == "min" else blank.min
        x = x.fill_null(blank).to_numpy(zero_copy_only=False).astype(np.int64 if number else np.float64)
        if kind != "sum" and not number:
            x = np.where(known, x, np.inf if kind == "min" else -np.inf)
        groups = pd.Series(x).groupby(code)
        folded = groups.cumsum() if kind == "sum" else groups.cummin() if kind == "min" else groups.cummax()
        out = pa.array(folded.to_numpy(), mask=none)
        return (out.cast(pa.int32()) if pa.types.is_date32(result) else out).cast(result)
    held, total, out = values.to_pylist(), None, []
    for i, v in enumerate(held):
        total = merged(kind, None if first[i] == i else total, v)
        out.append(total)
    return pa.array(out, result)


def continued(kind: str, before: pa.Array, parts: pa.Array) -> pa.Array:
    """Running folds inside a part as running folds from the beginning, given each row's totals before the part."""
    if before.null_count == len(before):
        return parts
    if kind in ("count", "sum"):
        return pc.coalesce(pc.add(parts, before).cast(parts.type), parts, before)
    if pa.types.is_timestamp(parts.type) and kind != "last":
        whole = continued(kind, before.cast(pa.int64()), parts.cast(pa.int64()))
        return whole.cast(parts.type)
    simple = pa.types.is_primitive(parts.type) and not pa.types.is_boolean(parts.type)
    if simple and not _has_nan(parts) and not _has_nan(before) and kind != "last":
        return (pc.min_element_wise if kind == "min" else pc.max_element_wise)(parts, before)
    both = zip(_plain(before), _plain(parts), strict=True)
    return _arrow([merged("max" if kind == "last" else kind, a, b) for a, b in both], parts.type)


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _read(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all().combine_chunks()


def _key_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Each row's key as a number from 0; a null is a key."""
    number = np.zeros(table.num_rows, np.int64)
    for name in keys:
        coded = _whole(table[name]).dictionary_encode(null_encoding="encode")
        number = number * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
        number = np.unique(number, return_inverse=True)[1]
    return number


def _sorted(table: pa.Table, keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    """A part's rows by key and order, and the numbers of their keys, which count from 0."""
    table = table.append_column("_code", pa.array(_key_numbers(table, keys)))
    sort = [("_code", "ascending")] + [(name, "ascending") for name in table.column_names if name.startswith("_order")]
    table = table.take(pc.sort_indices(table, sort, null_placement="at_start")).combine_chunks()
    return table, table["_code"].to_numpy()


def _folded(table: pa.Table, code: np.ndarray, folds: list[Fold]) -> dict[str, pa.Array]:
    return {f"_f{i}": running(f.kind, _whole(table[f"_v{i}"]), code, table[f"_t{i}"].type) for i, f in enumerate(folds)}


def _chunk(keys: list[str], folds: list[Fold]):
    """A part's rows as one row: its keys with their totals."""

    def chunk(table: pa.Table) -> pa.Table:
        table, code = _sorted(table, keys)
        begins = np.flatnonzero(np.diff(code, prepend=-1))
        ends = pa.array(np.append(begins[1:], len(code)) - 1)
        totals = {name: column.take(ends) for name, column in _folded(table, code, folds).items()}
        by_key = pa.table({k: table[k].take(begins) for k in keys} | totals)
        out = {name: table[name].slice(0, 1) for name in PART}
        out["_at"] = pa.array([pc.max(table["_at"]).as_py()], table["_at"].type)
        return pa.table(out | {"_keys": pa.array([_packed(by_key)], pa.binary())})

    return chunk


def _utc(value, kind: DataType):
    """State gives times without a zone, of this machine's; Arrow gives and takes them in UTC."""
    if isinstance(kind, StructType) and value is not None:
        return tuple(_utc(v, f.dataType) for v, f in zip(value, kind, strict=True))
    if isinstance(kind, TimestampType) and isinstance(value, datetime) and value.tzinfo is None:
        return value.astimezone(timezone.utc)
    return value


class EntryProcessor(StatefulProcessor):
    """Keeps an entry per key: its totals, then its attributes. All keys of a bucket are complete together."""

    def __init__(self, key: StructType, folds: list[Fold], totals: StructType, attributes: StructType, complete_ms: int | None):
        self.key = key
        self.folds = folds
        self.state = StructType([*totals.fields, *attributes.fields])
        self.attributes = attributes.names
        self.complete_ms = complete_ms
        self.nothing = (*[0 if f.kind == "count" else None for f in folds], *[None] * len(self.attributes))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entries = handle.getMapState("entry", self.key, self.state)
        self.flushed = handle.getValueState("flushed", StructType([StructField("flushed", BooleanType())]))
        self.size = handle.getValueState("size", StructType([StructField("size", LongType())]))
        self.kinds = [to_arrow_type(f.dataType) for f in self.state]
        self.key_kinds = [to_arrow_type(f.dataType) for f in self.key]
        self.begun: set[int] = set()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._begin(key[0])
        given = initialState.asDict()
        entry = [given.get(name, blank) for name, blank in zip(self.state.names, self.nothing, strict=True)]
        self.entries.updateValue(tuple(given[k] for k in self.key.names), tuple(entry))

    def _begin(self, bucket: int) -> None:
        """The bucket's timer, set with its first entry."""
        if self.complete_ms is not None and bucket not in self.begun:
            self.begun.add(bucket)
            if not self.flushed.exists():
                self.flushed.update((False,))
                self.handle.registerTimer(self.complete_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self._begin(key[0])
        waits = self.complete_ms is not None and not self.flushed.get()[0]
        names = [f"_f{i}" for i in range(len(self.folds))]
        n, parts = len(names), []
        for row in sorted(rows, key=lambda r: (r["_after"], r["_slice"])):
            by_key = _read(bytes(row["_keys"]))
            keys = [_utc(k, self.key) for k in zip(*[_plain(by_key[k]) for k in self.key.names], strict=True)]
            parts.append((row, by_key, keys, [_plain(by_key[name]) for name in names]))
        held = self._entries(dict.fromkeys(k for _, _, keys, _ in parts for k in keys))
        for row, by_key, keys, totals in parts:
            if row["_after"] and waits:
                self._store(held)
                yield from self._flush(key[0])
                waits = False
            if row["_after"]:
                shown = [_whole(by_key[k]) for k in self.key.names]
                yield self._row((key[0], True, row["_slice"]), "stream", shown, [held.get(k, self.nothing) for k in keys])
            for k, *added in zip(keys, *totals, strict=True):
                old = held.get(k, self.nothing)
                # The kind "last" merges as the highest order does.
                new = [merged("max" if f.kind == "last" else f.kind, x, y) for f, x, y in zip(self.folds, old, added, strict=False)]
                held[k] = (*new, *old[n:])
        self._store(held)

    def _entries(self, keys: dict[tuple, None]) -> dict[tuple, tuple]:
        """The entries of these keys that there are. Every call on a state is a message, so if the keys are many of
        the bucket's, all of its entries are read together. ``size`` counts them, once it has been told."""
        size = self.size.get()
        if size is not None and READ_ALONE * len(keys) < size[0]:
            found = ((k, self.entries.getValue(k)) for k in keys)
            held = {k: _utc(tuple(e), self.state) for k, e in found if e is not None}
            number = size[0]
        else:
            pairs = {_utc(tuple(k), self.key): e for k, e in self.entries.iterator()}
            held = {k: _utc(tuple(e), self.state) for k, e in pairs.items() if k in keys}
            number = len(pairs)
        number += len(keys) - len(held)
        if size is None or number != size[0]:
            self.size.update((number,))
        return held

    def _store(self, held: dict[tuple, tuple]) -> None:
        for key, entry in held.items():
            self.entries.updateValue(key, entry)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.flushed.get()[0]:
            yield from self._flush(key[0])

    def _flush(self, bucket: int) -> Iterator[Row]:
        """All entries, in rows that are parts of their own."""
        keys, entries, n = [], [], 0
        for key, entry in self.entries.iterator():
            keys.append(_utc(tuple(key), self.key))
            entries.append(_utc(tuple(entry), self.state))
            if len(keys) == ENTRIES_PER_ROW:
                yield self._row((bucket, False, n), "flush", self._columns(keys), entries)
                keys, entries, n = [], [], n + 1
        if keys:
            yield self._row((bucket, False, n), "flush", self._columns(keys), entries)
        self.flushed.update((True,))

    def _columns(self, keys: list[tuple]) -> list[pa.Array]:
        return [_arrow([k[i] for k in keys], kind) for i, kind in enumerate(self.key_kinds)]

    def _row(self, part: tuple, phase: str, keys: list[pa.Array], entries: list[tuple]) -> Row:
        columns = {f"_k{i}": column for i, column in enumerate(keys)}
        columns |= {f"_e{i}": _arrow([e[i] for e in entries], kind) for i, kind in enumerate(self.kinds)}
        return Row(*PART, "_phase", "_entries")(*part, phase, _packed(pa.table(columns)))

    def close(self) -> None:
        pass


def _continued_rows(keys: list[str], rows: list[str], folds: list[Fold], attributes: list[str], out: StructType):
    """A part's rows, with folds that continue the totals its entries have; entries that are flushed are rows by themselves."""
    names, kinds = out.names, [to_arrow_type(f.dataType) for f in out]

    def shaped(columns: dict, n: int, phase: str) -> pa.Table:
        columns["phase"] = pa.array([phase] * n, pa.string())
        arrays = [columns[name].cast(kind) if name in columns else pa.nulls(n, kind) for name, kind in zip(names, kinds, strict=True)]
        return pa.table(arrays, names)

    def continue_rows(table: pa.Table) -> pa.Table:
        told = table.filter(pc.is_valid(table["_entries"]))
        if not told.num_rows:  # later than the watermark allows: the state has not seen them
            return shaped({}, 0, "stream")
        entry = _read(told["_entries"][0].as_py())
        if told["_phase"][0].as_py() == "flush":
            columns = {k: _whole(entry[f"_k{i}"]) for i, k in enumerate(keys)}
            columns |= {name: _whole(entry[f"_e{i}"]) for i, name in enumerate([*[f.name for f in folds], *attributes])}
            return shaped(columns, entry.num_rows, "flush")
        table, code = _sorted(table.filter(pc.is_null(table["_entries"])), keys)
        n, begins = table.num_rows, np.flatnonzero(np.diff(code, prepend=-1))
        # The entries' keys are those of the rows, in a sequence of their own.
        both = {k: pa.concat_arrays([_whole(table[k].take(begins)), _whole(entry[f"_k{i}"]).cast(table[k].type)]) for i, k in enumerate(keys)}
        number = _key_numbers(pa.table(both), keys)
        place = np.empty(len(begins), np.int64)
        place[np.argsort(number[: len(begins)])] = np.argsort(number[len(begins) :])
        at = pa.array(place[code])
        columns = {name: _whole(table[name]) for name in rows}
        for i, (f, parts) in enumerate(zip(folds, _folded(table, code, folds).values(), strict=True)):
            before = _whole(entry[f"_e{i}"]).take(at)
            columns[f.name] = continued(f.kind, before, parts.cast(before.type))
        columns |= {a: _whole(entry[f"_e{len(folds) + i}"]).take(at) for i, a in enumerate(attributes)}
        return shaped(columns, n, "stream")

    return continue_rows


def join_stream(
    stream: DataFrame,
    key: list[str],
    order: list[str],
    folds: list[Fold],
    side: DataFrame | None = None,
    complete_at: str | None = None,
    slice_width: float = SLICE_WIDTH,
    buckets: int = BUCKETS,
    watermark: str = "0 seconds",
) -> DataFrame:
    """Each row of the stream with the totals of its key so far and the key's attributes.

    Rows fold in ``order`` inside a micro-batch and in order of arrival across them. ``side`` gives a
    key its attributes, and the totals to start from if it has columns named like folds. It is loaded
    once into the state; rows that repeat a key are folded to one, a null key finds no attributes.

    With ``complete_at`` the batch side counts as complete once the first order column, a time, reaches
    it. Earlier rows are only folded. Then every entry comes out once, with ``phase`` "flush": when a row of
    its bucket comes, or else by the bucket's timer when the watermark passes ``complete_at``; so keys that
    only the batch side has come out too. Later rows come out as ``phase`` "stream"; a key first seen
    after completion has no entry to flush. Rows that come later than ``watermark`` allows are dropped by
    Spark. Batch rows without a key are in no state; they are the caller's to add.

    ``last`` folds come out with their order, see :func:`~hybridflow.operators.rolling.with_values`.
    """
    spark = stream.sparkSession
    use_rocksdb_state(spark)
    rows = stream.columns
    time = stream.schema[order[0]].dataType
    number = _as_number(stream, order[0])
    scale = MICROS if isinstance(time, (TimestampType, TimestampNTZType)) else 1
    complete_ms, after = None, F.lit(True)
    if complete_at is not None:
        after = F.coalesce(F.col(order[0]) >= F.lit(complete_at).cast(time), F.lit(False))
        complete_ms = spark.sql(f"SELECT unix_millis(TIMESTAMP '{complete_at}')").first()[0]
    helpers = {
        "_bucket": F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"),
        "_after": after,
        "_slice": F.coalesce(F.floor(number / (slice_width * scale)), F.lit(-(2**63))),
        "_at": F.lit(None).cast("timestamp") if complete_at is None else F.col(order[0]).cast("timestamp"),
    }
    helpers |= {f"_order{i}": F.col(c) for i, c in enumerate(order)}
    types = [f.result_type(stream.schema) for f in folds]
    for i, (f, kind) in enumerate(zip(folds, types, strict=True)):
        if f.kind == "last":
            parts = [F.col(c).alias(f"at{k}") for k, c in enumerate(f.order)]
            value = F.when(F.col(f.column).isNotNull(), F.struct(*parts, F.col(f.column).alias("value")))
        else:
            value = F.lit(1) if f.kind == "count" else F.col(f.column)
        helpers |= {f"_v{i}": value, f"_t{i}": F.lit(None).cast(kind)}
    of_part = [StructField("_bucket", stream.select(helpers["_bucket"]).schema[0].dataType), StructField("_after", BooleanType()), StructField("_slice", LongType())]
    chunked = StructType([*of_part, StructField("_at", TimestampType()), StructField("_keys", BinaryType())])
    placed = stream.withColumns(helpers)
    chunks = placed.drop(*[c for c in rows if c not in key]).groupBy(*PART).applyInArrow(_chunk(key, folds), chunked)
    if complete_at is not None:
        chunks = chunks.withWatermark("_at", watermark)

    names = {f.name for f in folds}
    known = None if side is None else known_keys(side, key)
    attributes = [] if side is None else [c for c in side.columns if c not in key and c not in names]
    keys = StructType([StructField(k, stream.schema[k].dataType, True) for k in key])
    totals = StructType([StructField(f.name, t, True) for f, t in zip(folds, types, strict=True)])
    extra = StructType([StructField(a, side.schema[a].dataType, True) for a in attributes])
    if known is not None:
        same = [F.col(k).cast(stream.schema[k].dataType).alias(k) for k in key]
        known = known.select(*same, *[c for c in known.columns if c not in key])
        known = known.withColumn("_bucket", helpers["_bucket"]).groupBy("_bucket")
    told = StructType([*of_part, StructField("_phase", StringType()), StructField("_entries", BinaryType())])
    entries = chunks.groupBy("_bucket").transformWithState(
        statefulProcessor=EntryProcessor(keys, folds, totals, extra, complete_ms),
        outputStructType=told,
        outputMode="Append",
        timeMode="None" if complete_at is None else "EventTime",
        initialState=known,
    )
    out = StructType([*stream.schema.fields, *totals.fields, *extra.fields, StructField("phase", StringType())])
    both = placed.where("_after").drop("_at").unionByName(entries, allowMissingColumns=True)
    return both.groupBy(*PART).applyInArrow(_continued_rows(key, rows, folds, attributes, out), out)
