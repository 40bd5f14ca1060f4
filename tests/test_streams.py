"""Stream forms give the rows of the table forms however the input is cut, also after a stop."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from hybridflow.functions.words import words_of
from hybridflow.operators.hybrid_join import enrich, full, snapshot
from hybridflow.operators.rolling import Fold, fold_totals, rolling_fold, with_values
from hybridflow.operators.windows import sliding_counts
from hybridflow.sources.queue import BatchQueue, split_at
from hybridflow.sources.streams import file_stream, kafka_messages, kafka_options, socket_lines
from hybridflow.streaming.keyed_join import _chunk, join_stream
from hybridflow.streaming.sinks import batch_folder, every, per_batch_totals, print_stream, read_batches
from hybridflow.streaming.state import state_table
from hybridflow.streaming.stateful import co_map_stream, totals_stream, totals_updates
from hybridflow.streaming.transactional import committed_files, read_committed, register_sink

KEY, ORDER = ["k"], ["ts", "id"]
FOLDS = [Fold("n", "count"), Fold("total", "sum", "v"), Fold("low", "min", "v"), Fold("high", "max", "v")]
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Every partition has a state store, so small inputs want few."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = [
        (1 if i % 3 == 0 else rng.randrange(12), START + timedelta(seconds=i), i,
         None if i % 10 == 0 else rng.randrange(-20, 20))
        for i in range(210)
    ]
    return spark.createDataFrame(data, "k BIGINT, ts TIMESTAMP, id BIGINT, v BIGINT")


@pytest.fixture(scope="module")
def side(spark):
    return spark.createDataFrame([(k, f"a{k}") for k in range(6, 20)], "k BIGINT, a STRING")


def batches(rows, n):
    if n == 1:
        return [rows]
    cuts = [str(START + timedelta(seconds=210 * i // n)) for i in range(1, n)]
    return split_at(rows, "ts", cuts)


def as_set(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def joined(spark, parts, path, *args, folds=FOLDS, **kwargs):
    """All rows :func:`join_stream` gives for micro-batches."""
    def sink(s):
        return with_values(join_stream(s, KEY, ORDER, folds, *args, **kwargs), folds).writeStream.foreachBatch(batch_folder(path))

    queue = BatchQueue(spark)
    queue.run(parts, sink)
    return read_batches(spark, path).drop("batch_id"), queue


@pytest.mark.parametrize("n, width", [(1, 3_600), (2, 10), (7, 60)])
def test_stream_rows_equal_table_rows(spark, rows, side, tmp_path, n, width):
    got, _ = joined(spark, batches(rows, n), str(tmp_path / "out"), side, slice_width=width)
    assert as_set(got.drop("phase")) == as_set(enrich(rows, side, KEY, ORDER, FOLDS))
    assert got.where("phase <> 'stream'").count() == 0


@pytest.mark.parametrize("n", [1, 3])
def test_totals_in_keyed_state(spark, rows, side, tmp_path, n):
    out = str(tmp_path / "out")
    BatchQueue(spark).run(
        batches(rows, n),
        lambda s: totals_stream(s, KEY, FOLDS, side).writeStream.foreachBatch(batch_folder(out)),
    )
    entries = read_batches(spark, out)
    assert entries.groupBy("k", "batch_id").count().where("count > 1").count() == 0
    last = entries.groupBy("k").agg(F.max_by(F.struct("n", "total", "low", "high", "a"), "batch_id").alias("e"))
    expected = snapshot(rows, side, KEY, FOLDS).where("n > 0")
    assert as_set(last.select("k", "e.*")) == as_set(expected)


@pytest.mark.parametrize("n", [1, 3])
def test_totals_in_update_mode(spark, rows, tmp_path, n):
    """Spark's own state: no Python in the plan, a row per key and micro-batch."""
    out, folds = str(tmp_path / "out"), [*FOLDS, Fold("latest", "last", "v", ("ts", "id"))]
    odd = rows.withColumn("k", F.when(F.col("k") != 3, F.col("k")))
    queue = BatchQueue(spark)
    queue.run(batches(odd, n), lambda s: totals_updates(s, KEY, folds).writeStream.outputMode("update").foreachBatch(batch_folder(out)))
    entries = read_batches(spark, out)
    assert entries.groupBy("k", "batch_id").count().where("count > 1").count() == 0
    names = [f.name for f in folds]
    last = entries.groupBy("k").agg(F.max_by(F.struct(*names), "batch_id").alias("e")).select("k", "e.*")
    assert as_set(last) == as_set(fold_totals(odd, KEY, folds))
    plan = totals_updates(queue.stream(odd), KEY, folds)._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "TransformWithState" not in plan


def test_totals_share_groups(spark, rows, side, tmp_path):
    """The state has a group per bucket, not per key; times and keys with a batch side too."""
    out, queue, first = str(tmp_path / "out"), BatchQueue(spark), [*FOLDS, Fold("begun", "min", "ts")]
    def sink(s):
        return totals_stream(s, KEY, first, side, buckets=3).writeStream.foreachBatch(batch_folder(out))

    queue.run(batches(rows, 3), sink)
    assert state_table(spark, queue.checkpoint, "size").count() <= 3
    entries = state_table(spark, queue.checkpoint, "entry").drop("_bucket")
    assert as_set(entries) == as_set(snapshot(rows, side, KEY, first))


def test_totals_of_large_numbers_and_null_keys(spark, tmp_path):
    out, big = str(tmp_path / "out"), 2**62 + 1
    rows = spark.createDataFrame(
        [(big, 2**31 - 1, big), (big, 1, None), (None, 3, 5), (None, 4, None)], "k BIGINT, i INT, v BIGINT"
    )
    folds = [Fold("total", "sum", "i"), Fold("high", "max", "v")]
    BatchQueue(spark).run(
        [rows], lambda s: totals_stream(s, KEY, folds).writeStream.foreachBatch(batch_folder(out))
    )
    found = read_batches(spark, out).select("k", "total", "high").collect()
    assert set(map(tuple, found)) == {(big, 2**31, big), (None, 7, 5)}


@pytest.fixture(scope="module")
def odd_rows(rows):
    """A sixth of the rows has no key."""
    return rows.withColumn("k", F.when(F.col("id") % 6 == 1, None).otherwise(F.col("k")))


@pytest.fixture(scope="module")
def odd_side(spark):
    """Repeated keys, and rows without a key."""
    return spark.createDataFrame([(k, f"a{k}") for k in range(6, 20)] + [(7, "b"), (7, "c"), (None, "n")], "k BIGINT, a STRING")


def test_null_and_repeated_keys_as_in_the_table(spark, odd_rows, odd_side, tmp_path):
    got, _ = joined(spark, batches(odd_rows, 3), str(tmp_path / "out"), odd_side)
    assert as_set(got.drop("phase")) == as_set(enrich(odd_rows, odd_side, KEY, ORDER, FOLDS))


LAST = [*FOLDS, Fold("latest", "last", "v", ("ts", "id"))]


@pytest.mark.parametrize("n, width", [(1, 7), (3, 3_600), (4, 20)])
def test_full_join_flushes_out_of_keyed_state(spark, odd_rows, odd_side, tmp_path, n, width):
    """Entries come out once: with their key's next row, or by their timer; also keys only the batch side has."""
    cut = str(START + timedelta(seconds=100))
    side = odd_side.where("k IS NOT NULL")
    got, queue = joined(spark, batches(odd_rows, n), str(tmp_path / "out"), side, folds=LAST, complete_at=cut, slice_width=width)
    expected = full(odd_rows, side, KEY, ORDER, LAST, cut)
    flushed = ["k", "n", "total", "low", "high", "latest", "a"]
    assert as_set(got.where("phase = 'flush'").select(flushed)) == as_set(expected.where("phase = 'flush'").select(flushed))
    assert as_set(got.where("phase = 'stream'").select("id", "ts", *flushed)) == as_set(
        expected.where("phase = 'stream'").select("id", "ts", *flushed)
    )
    assert state_table(spark, queue.checkpoint, "flushed").where("NOT flushed").count() == 0
    state = with_values(state_table(spark, queue.checkpoint, "entry"), LAST)
    assert as_set(state.drop("_bucket")) == as_set(snapshot(odd_rows, side, KEY, LAST))


def test_nothing_comes_out_before_completion(spark, rows, side, tmp_path):
    never = str(START + timedelta(days=1))
    got, queue = joined(spark, batches(rows, 2), str(tmp_path / "out"), side, complete_at=never)
    assert got.count() == 0
    assert state_table(spark, queue.checkpoint, "entry").count() == snapshot(rows, side, KEY, FOLDS).count()


def test_a_side_with_some_of_the_folds(spark, rows, tmp_path):
    side = spark.createDataFrame([(1, 100), (2, 200)], "k BIGINT, total BIGINT")
    got, _ = joined(spark, batches(rows, 2), str(tmp_path / "out"), side)
    first = rows.where("k = 1").orderBy("id").select(F.coalesce("v", F.lit(0)).alias("v")).first()["v"]
    one = got.where("k = 1").orderBy("id").select("n", "total").first()
    assert (one["n"], one["total"]) == (1, 100 + first)


@pytest.mark.parametrize("kind", ["int", "double", "decimal(5,2)", "string", "timestamp", "date"])
def test_running_folds_of_every_type(spark, tmp_path, kind):
    rng = random.Random(4)
    values = [None if rng.random() < 0.3 else rng.randrange(1, 28) for _ in range(60)]
    data = [(i % 2, START + timedelta(seconds=i // 2 * 2), i, v) for i, v in enumerate(values)]
    rows = spark.createDataFrame(data, "k BIGINT, ts TIMESTAMP, id BIGINT, v BIGINT")
    value = F.date_add(F.lit("2024-01-01"), F.col("v").cast("int")).cast(kind) if kind in ("timestamp", "date") else F.col("v").cast(kind)
    rows = rows.withColumn("v", value)
    folds = [Fold("n", "count"), Fold("low", "min", "v"), Fold("high", "max", "v"), Fold("latest", "last", "v", ("ts", "id"))]
    if kind not in ("string", "timestamp", "date"):
        folds.append(Fold("total", "sum", "v"))
    got, _ = joined(spark, batches(rows, 2), str(tmp_path / "out"), folds=folds, slice_width=9)
    expected = with_values(rolling_fold(rows, KEY, ORDER, folds), folds)
    assert as_set(got.drop("phase")) == as_set(expected)
    assert dict(got.drop("phase").dtypes) == dict(expected.dtypes)


def test_a_third_of_the_rows_under_one_key_is_sliced(spark, rows, tmp_path):
    """What the keyed state gets of a key is a row per slice, not per row."""
    seen = []

    def sink(s):
        chunks = join_stream(s, KEY, ORDER, FOLDS, slice_width=50)
        return chunks.writeStream.foreachBatch(lambda b, _: seen.append(b.count()))

    BatchQueue(spark).run([rows], sink)
    assert seen == [210]
    slices = rows.where("k = 1").select(F.floor(F.unix_seconds("ts") / 50)).distinct().count()
    assert slices == 5 and rows.where("k = 1").count() >= 70


def test_the_state_gets_no_rows(spark, tmp_path):
    """What a part gives the state does not grow with its rows; the rows meet their keys' entries, also by several keys."""
    n = 20_000
    part = pa.table({
        "k": pa.array([7] * n), "_bucket": pa.array([0] * n, pa.int32()), "_after": pa.array([True] * n), "_slice": pa.array([0] * n),
        "_at": pa.nulls(n, pa.timestamp("us", "UTC")), "_order0": pa.array(range(n)), "_v0": pa.array(range(n)), "_t0": pa.nulls(n, pa.int64()),
    })
    chunk = _chunk(["k"], [Fold("total", "sum", "v")])(part)
    assert chunk.num_rows == 1 and chunk.nbytes < 2_000

    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), START + timedelta(seconds=i), i, rng.randrange(9)) for i in range(300)]
    rng.shuffle(data)
    rows = spark.createDataFrame(data, "a STRING, b INT, ts TIMESTAMP, id BIGINT, v BIGINT").repartition(5)
    out, folds = str(tmp_path / "out"), [Fold("total", "sum", "v"), Fold("n", "count")]
    cuts = split_at(rows, "ts", [str(START + timedelta(seconds=s)) for s in (90, 200)])
    BatchQueue(spark).run(cuts, lambda s: join_stream(s, ["a", "b"], ORDER, folds, slice_width=20, buckets=3).writeStream.foreachBatch(batch_folder(out)))
    assert as_set(read_batches(spark, out).drop("batch_id", "phase")) == as_set(rolling_fold(rows, ["a", "b"], ORDER, folds))


def test_late_last_values_do_not_win(spark, tmp_path):
    """The order counts, not the arrival; a null order comes first, a null value never counts."""
    def at(s):
        return None if s is None else START + timedelta(seconds=s)

    parts = [[(1, at(5), 1, 50), (1, at(9), 2, None)], [(1, at(3), 3, 30), (1, None, 4, 1)], [(1, at(7), 5, 70), (1, at(7), 6, None)]]
    frames = [spark.createDataFrame(p, "k BIGINT, ts TIMESTAMP, id BIGINT, v BIGINT") for p in parts]
    folds = [Fold("latest", "last", "v", ("ts", "id"))]
    got, _ = joined(spark, frames, str(tmp_path / "out"), folds=folds)
    assert {r["id"]: r["latest"] for r in got.collect()} == {1: 50, 2: 50, 3: 50, 4: 50, 5: 70, 6: 70}


def test_a_stopped_join_goes_on_where_it_was(spark, rows, tmp_path):
    out, first = str(tmp_path / "out"), BatchQueue(spark)

    def sink(s):
        return join_stream(s, KEY, ORDER, FOLDS).writeStream.foreachBatch(batch_folder(out))

    parts = batches(rows, 2)
    first.run(parts[:1], sink)
    BatchQueue(spark, first.path, first.checkpoint).run(parts[1:], sink)
    got = read_batches(spark, out).drop("batch_id", "phase")
    assert as_set(got) == as_set(rolling_fold(rows, KEY, ORDER, FOLDS))


def test_decimal_totals_in_keyed_state(spark, tmp_path):
    rows = spark.createDataFrame([(1, START, i, 900) for i in range(3)], "k BIGINT, ts TIMESTAMP, id BIGINT, v INT")
    rows, out = rows.withColumn("v", F.col("v").cast("decimal(3,0)")), str(tmp_path / "b")
    folds = [Fold("total", "sum", "v")]
    BatchQueue(spark).run([rows], lambda s: totals_stream(s, KEY, folds).writeStream.foreachBatch(batch_folder(out)))
    assert [int(r["total"]) for r in read_batches(spark, out).collect()] == [2700]


def test_windowed_word_count_of_a_socket_is_a_stream(spark):
    lines = socket_lines(spark, "localhost", 9999).withColumnRenamed("timestamp", "ts")
    counts = sliding_counts(words_of(lines, "value", "ts"), length=300, slide=1, watermark=10)
    assert counts.isStreaming and counts.columns == ["w_end", "word", "n"]


def test_per_batch_totals_forget(spark, tmp_path):
    out = str(tmp_path / "out")
    write = batch_folder(out, per_batch_totals(["k"], "v"))
    parts = [spark.createDataFrame([("a", i), ("a", 10 * i)], "k STRING, v BIGINT") for i in (1, 2)]
    BatchQueue(spark).run(parts, lambda s: s.writeStream.foreachBatch(write))
    assert sorted(map(tuple, read_batches(spark, out).select("batch_id", "k", "total").collect())) == [
        (0, "a", 11), (1, "a", 22)
    ]


def test_connected_inputs_share_state(spark, tmp_path):
    """Stream rows wait for their key's batch row, as many as there are."""
    out = str(tmp_path / "out")
    schema = "side STRING, k BIGINT, value BIGINT, name STRING, text STRING"
    early = [("stream", 1, v, None, None) for v in range(300)] + [("stream", 2, 7, None, None)]
    parts = [
        spark.createDataFrame(early, schema),
        spark.createDataFrame([("batch", 1, None, "a", "x"), ("stream", 3, 1, None, None)], schema),
        spark.createDataFrame([("stream", 1, 300, None, None), ("batch", 3, None, "b", "y")], schema),
    ]
    result = StructType([StructField(n, t) for n, t in (("k", LongType()), ("value", LongType()), ("seen", StringType()))])

    def seen(key, values, known):
        return pd.DataFrame({"k": key[0], "value": values, "seen": ",".join(sorted(known.values()))})

    def sink(s):
        return co_map_stream(s, "k", seen, result, salts=3).writeStream.foreachBatch(batch_folder(out))

    BatchQueue(spark).run(parts, sink)
    got = sorted(map(tuple, read_batches(spark, out).select("batch_id", "k", "value", "seen").collect()))
    assert got == [(1, 1, v, "x") for v in range(300)] + [(2, 1, 300, "x"), (2, 3, 1, "y")]


def test_a_hot_key_waits_in_all_its_salts(spark, tmp_path):
    """A third of the rows under one key: no group holds more than its share; null keys meet nothing."""
    schema = "side STRING, k BIGINT, value BIGINT, name STRING, text STRING"
    early = [("stream", 1 if v % 3 == 0 else 1000 + v, v, None, None) for v in range(900)] + [("stream", None, 5, None, None)]
    late = [("batch", 1, None, "a", "x"), ("batch", None, None, "a", "none"), ("batch", 1004, None, "a", "y"), ("batch", 1004, None, "b", None)]
    result = StructType([StructField(n, t) for n, t in (("k", LongType()), ("value", LongType()), ("seen", StringType()))])
    out, queue = str(tmp_path / "out"), BatchQueue(spark)

    def seen(key, values, known):
        return pd.DataFrame({"k": key[0], "value": values, "seen": ",".join(sorted(v or "-" for v in known.values()))})

    def sink(s):
        return co_map_stream(s, "k", seen, result, salts=8).writeStream.foreachBatch(batch_folder(out))

    queue.run([spark.createDataFrame(early, schema)], sink)
    waiting = state_table(spark, queue.checkpoint, "waiting").where("k = 1").groupBy("_salt").count().collect()
    assert sum(r["count"] for r in waiting) == 300 and max(r["count"] for r in waiting) < 2 * 300 / 8
    queue.run([spark.createDataFrame(late, schema)], sink)
    got = sorted(map(tuple, read_batches(spark, out).select("k", "value", "seen").collect()))
    assert got == [(1, v, "x") for v in range(0, 900, 3)] + [(1004, 4, "-,y")]
    held = state_table(spark, queue.checkpoint, "attributes").where("k = 1004")
    assert held.groupBy("_salt").count().where("count <> 2").count() == 0 and held.select("_salt").distinct().count() == 8


def test_connected_keys_share_groups(spark, tmp_path):
    """The state has a group per bucket and salt, not per key; the rows are those of a join, values unchanged."""
    schema, big = "side STRING, k BIGINT, value BIGINT, name STRING, text STRING", 2**53 + 1
    early = [("stream", v % 50, big + v, None, None) for v in range(400)]
    first = [("batch", k, None, "a", f"x{k}") for k in range(0, 30)] + [("stream", 70, big, None, None), ("stream", 70, big + 1, None, None)]
    second = [("batch", k, None, "b", f"y{k}") for k in range(20, 40)] + [("stream", 25, -1, None, None), ("stream", 70, -2, None, None)]
    result = StructType([StructField(n, t) for n, t in (("k", LongType()), ("value", LongType()), ("seen", StringType()))])
    out, queue = str(tmp_path / "out"), BatchQueue(spark)

    def seen(key, values, known):
        assert values.dtype == "int64"
        return pd.DataFrame({"k": key[0], "value": values, "seen": ",".join(known[n] for n in sorted(known))})

    def sink(s):
        return co_map_stream(s, "k", seen, result, salts=2, buckets=3).writeStream.foreachBatch(batch_folder(out))

    queue.run([spark.createDataFrame(rows, schema) for rows in (early, first, second)], sink)
    got = sorted(map(tuple, read_batches(spark, out).select("batch_id", "k", "value", "seen").collect()))
    expected = [(1, v % 50, big + v, f"x{v % 50}") for v in range(400) if v % 50 < 30]
    expected += [(2, v % 50, big + v, f"y{v % 50}") for v in range(400) if 30 <= v % 50 < 40]
    assert got == sorted([*expected, (2, 25, -1, "x25,y25")])
    assert state_table(spark, queue.checkpoint, "told").count() <= 2 * 3
    waiting = state_table(spark, queue.checkpoint, "waiting")
    assert sorted(r["value"] for r in waiting.where("k = 70").collect()) == [-2, big, big + 1]
    assert waiting.count() == 3 + 8 * 10 and state_table(spark, queue.checkpoint, "attributes").count() == 2 * 50


@pytest.mark.parametrize("kind", ["double", "timestamp", "string", "decimal(5,2)"])
def test_connected_keys_of_any_type(spark, tmp_path, kind):
    schema = "side STRING, k BIGINT, value DOUBLE, name STRING, text STRING"
    key = F.when(F.col("k") < 0, F.lit("NaN").cast("double") if kind == "double" else None).otherwise(F.col("k").cast("int")).cast(kind)
    early = [("stream", k, v, None, None) for k, v in ((3, 0.5), (3, None), (-1, 2.0), (4, 1.0))]
    late = [("batch", 3, None, "a", "x"), ("batch", -1, None, "a", "n"), ("stream", 3, 9.0, None, None), ("stream", -1, 3.0, None, None)]
    frames = [spark.createDataFrame(rows, schema).withColumn("k", key) for rows in (early, late)]
    result = StructType([StructField("k", frames[0].schema["k"].dataType), StructField("value", DoubleType()), StructField("seen", StringType())])
    out = str(tmp_path / "out")

    def seen(key, values, known):
        return pd.DataFrame({"k": [key[0]] * len(values), "value": values, "seen": known["a"]})

    BatchQueue(spark).run(frames, lambda s: co_map_stream(s, "k", seen, result, salts=2).writeStream.foreachBatch(batch_folder(out)))
    got = read_batches(spark, out)
    expected = [("x", 0.5), ("x", 9.0), ("x", None)] + ([("n", 2.0), ("n", 3.0)] if kind == "double" else [])
    found = [(r["seen"], None if r["value"] is None or r["value"] != r["value"] else r["value"]) for r in got.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert got.where(F.col("seen") == "x").select("k").distinct().collect() == frames[1].where("text = 'x'").select("k").collect()


def test_a_failed_and_repeated_micro_batch_leaves_one_copy(spark, tmp_path):
    register_sink(spark)
    out, queue = str(tmp_path / "out"), BatchQueue(spark)
    parts = [spark.range(i * 100, i * 100 + 100).withColumn("v", F.col("id") % 7).repartition(3) for i in range(3)]

    def sink(s):
        return s.writeStream.format("transactional").option("path", out).option("fileBytes", "1")

    def failing(s):
        bad = s.withColumn("v", F.when(F.col("id") == 150, F.raise_error(F.lit("no more"))).otherwise(F.col("v")).cast("bigint"))
        return sink(bad)

    def ids():
        return sorted(r["id"] for r in read_committed(spark, out, parts[0].schema).collect())

    queue.run(parts[:1], sink)
    assert ids() == list(range(100))
    with pytest.raises(Exception, match="no more"):
        queue.run(parts[1:2], failing)
    assert ids() == list(range(100)) and set(committed_files(out)) == {0}
    queue.run([parts[2]], sink)  # the failed micro-batch comes again, as it was planned, then the new one
    assert ids() == list(range(300))
    # A driver that was lost after the manifest and before Spark's own log runs the micro-batch once more.
    before, log = committed_files(out), max(Path(queue.checkpoint, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    log.unlink()
    log.with_name(f".{log.name}.crc").unlink(missing_ok=True)
    queue.run([parts[0].limit(0)], sink)
    after = committed_files(out)
    assert all(after[b] == files for b, files in before.items())
    assert ids() == list(range(300))
    kept = {f for files in after.values() for f in files}
    assert {f"{out}/data/{p.name}" for p in Path(out, "data").glob("*.parquet")} == kept


def test_sources_are_lazy(spark, tmp_path):
    lines = socket_lines(spark, "localhost", 9999)
    assert lines.isStreaming and lines.columns == ["value", "timestamp"]
    assert socket_lines(spark, "localhost", 9999, timestamps=False).columns == ["value"]
    options = kafka_options("host:9092", "topic", rows_per_trigger=5)
    assert options["subscribe"] == "topic" and options["maxOffsetsPerTrigger"] == "5"
    assert "maxOffsetsPerTrigger" not in kafka_options("h", "t", rows_per_trigger=None)
    try:
        assert kafka_messages(spark, "host:9092", "topic").isStreaming
    except Exception as e:
        assert "kafka" in str(e).lower()


def test_file_stream_and_print(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one two\nthree\n")
    stream = file_stream(spark, str(tmp_path / "in"), "value STRING", fmt="text", max_files=1)
    printed = print_stream(stream).trigger(availableNow=True).start()
    printed.awaitTermination()
    assert printed.lastProgress["numInputRows"] == 2
    query = every(stream.writeStream.format("noop"), "1 second").start()
    query.processAllAvailable()
    assert query.isActive
    query.stop()
