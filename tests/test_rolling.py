"""Running folds and hybrid joins against plain Python, with and without slicing."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hybridflow.operators.hybrid_join import enrich, full, one_per_key, snapshot
from hybridflow.operators.rolling import Fold, fold_totals, merge_totals, rolling_fold, with_values

FOLDS = [
    Fold("n", "count"),
    Fold("total", "sum", "v"),
    Fold("low", "min", "v"),
    Fold("high", "max", "v"),
]
SCHEMA = "k BIGINT, ts TIMESTAMP, id BIGINT, v BIGINT"
START = datetime(2024, 1, 1)


def make_rows(seed, n=600):
    """A third of the rows has one key, a third no key, many share one time, some have none."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = [7, None, rng.randrange(20)][i % 3]
        when = rng.random()
        ts = START if when < 0.4 else None if when < 0.45 else START + timedelta(seconds=rng.randrange(50))
        v = None if rng.random() < 0.1 else rng.randrange(-50, 50)
        rows.append((k, ts, i, v))
    rng.shuffle(rows)
    return rows


def order_of(row):
    return (row[1] is not None, row[1] or START, row[2])


def merged(a, v):
    n, total, low, high = a
    if v is None:
        return (n + 1, total, low, high)
    if total is None:
        return (n + 1, v, v, v)
    return (n + 1, total + v, min(low, v), max(high, v))


def brute(rows, start=None):
    entries, out = dict(start or {}), {}
    for row in sorted(rows, key=order_of):
        entries[row[0]] = merged(entries.get(row[0], (0, None, None, None)), row[3])
        out[row[2]] = entries[row[0]]
    return out, entries


def found(df):
    return {r["id"]: (r["n"], r["total"], r["low"], r["high"]) for r in df.collect()}


@pytest.mark.parametrize("rows_per_slice", [10_000, 100, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_fold(spark, seed, rows_per_slice):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(rolling_fold(df, ["k"], ["ts", "id"], FOLDS, None, rows_per_slice)) == brute(rows)[0]


@pytest.mark.parametrize("order", [["ts", "id"], ["id"], ["day", "id"]])
def test_slices_are_small(spark, order):
    from hybridflow.operators.rolling import _with_slices

    df = spark.createDataFrame(make_rows(3, 3000), SCHEMA).withColumn("day", F.to_date("ts"))
    sliced = _with_slices(df.withColumn("_hot", F.lit(True)), order, 60)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 150


@pytest.mark.parametrize("rows_per_slice", [10_000, 50])
def test_enrich(spark, rows_per_slice):
    rows = make_rows(4)
    batch = spark.createDataFrame([(k, f"a{k}") for k in range(5, 40)] + [(None, "none")], "k BIGINT, a STRING")
    joined = enrich(spark.createDataFrame(rows, SCHEMA), batch, ["k"], ["ts", "id"], FOLDS, rows_per_slice)
    result = joined.collect()
    assert len(result) == len(rows)
    assert found(joined) == brute(rows)[0]
    for r in result:
        assert r["a"] == (f"a{r['k']}" if r["k"] is not None and r["k"] >= 5 else None)


@pytest.mark.parametrize("rows_per_slice", [10_000, 50])
def test_full_flushes_every_entry_once_and_goes_on_from_there(spark, rows_per_slice):
    rows, cut = make_rows(5), START + timedelta(seconds=25)
    batch_rows = [(k, k * 10) for k in range(5, 40)] + [(None, -1)]
    batch = spark.createDataFrame(batch_rows, "k BIGINT, a BIGINT")
    joined = full(
        spark.createDataFrame(rows, SCHEMA), batch, ["k"], ["ts", "id"], FOLDS, str(cut), rows_per_slice
    )
    early = [r for r in rows if r[1] is None or r[1] < cut]
    later = [r for r in rows if r[1] is not None and r[1] >= cut]
    _, entries = brute(early)
    expected, _ = brute(later, entries)
    assert found(joined.where("phase = 'stream'")) == expected
    flushed = [
        (r["k"], r["n"], r["total"], r["a"]) for r in joined.where("phase = 'flush'").collect()
    ]
    attributes = {k: a for k, a in batch_rows if k is not None}
    wanted = [
        (k, *entries.get(k, (0, None))[:2], attributes.get(k)) for k in {*entries, *attributes}
    ] + [(None, 0, None, -1)]
    assert sorted(flushed, key=str) == sorted(wanted, key=str)
    keyless = joined.where("phase = 'stream' and k is null")
    assert keyless.where("a is not null").count() == 0


def test_snapshot(spark):
    stream = spark.createDataFrame([(1, None, 1, 5), (1, None, 2, 6), (2, None, 3, 1)], SCHEMA)
    batch = spark.createDataFrame([(1, "x"), (3, "y")], "k BIGINT, a STRING")
    rows = snapshot(stream, batch, ["k"], [Fold("n", "count"), Fold("total", "sum", "v")])
    assert sorted(map(tuple, rows.collect())) == [(1, 2, 11, "x"), (2, 1, 1, None), (3, 0, None, "y")]


def test_one_per_key(spark):
    batch = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (2, 1, "c")], "k INT, at INT, a STRING")
    assert sorted(map(tuple, one_per_key(batch, ["k"], ["a"], "at").collect())) == [(1, "a"), (2, "c")]
    assert sorted(map(tuple, one_per_key(batch, ["k"], ["a"]).collect())) == [(1, "b"), (2, "c")]


def test_totals_of_parts_are_totals_of_the_whole(spark):
    df = spark.createDataFrame(make_rows(6), SCHEMA)
    parts = [fold_totals(df.where(f"id % 2 = {i}"), ["k"], FOLDS) for i in (0, 1)]
    whole = fold_totals(df, ["k"], FOLDS)
    both = merge_totals(parts[0], parts[1], ["k"], FOLDS)
    assert sorted(map(str, both.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("rows_per_slice", [1000, 20])
def test_keys_of_several_columns_and_types(spark, rows_per_slice):
    rng = random.Random(7)
    columns = {
        "s": ["0", "x", None],
        "d": [date(1970, 1, 1), date(2024, 1, 1), None],
        "b": [True, False, None],
        "m": [Decimal("0.00"), Decimal("1.50"), None],
    }
    rows = [tuple(rng.choice(v) for v in columns.values()) + (i, i) for i in range(500)]
    df = spark.createDataFrame(rows, "s STRING, d DATE, b BOOLEAN, m DECIMAL(5,2), id BIGINT, v BIGINT")
    rolled = rolling_fold(df, list(columns), ["id"], [Fold("total", "sum", "v")], None, rows_per_slice)
    totals, expected = {}, {}
    for row in rows:
        totals[row[:4]] = totals.get(row[:4], 0) + row[5]
        expected[row[4]] = totals[row[:4]]
    assert {r["id"]: r["total"] for r in rolled.collect()} == expected


@pytest.mark.parametrize("rows_per_slice", [1000, 3, 1])
def test_nulls_and_infinities_in_the_order(spark, rows_per_slice):
    inf = float("inf")
    rng = random.Random(8)
    rows = [(1, rng.choice([None, -inf, inf, float("nan"), 0.0, -2.5, 7.0]), i, i) for i in range(60)]
    df = spark.createDataFrame(rows, "k BIGINT, x DOUBLE, id BIGINT, v BIGINT")
    rolled = rolling_fold(df, ["k"], ["x", "id"], [Fold("total", "sum", "v")], None, rows_per_slice)

    def place(row):
        x = row[1]
        return (x is not None, x is not None and x != x, 0 if x is None or x != x else x, row[2])

    total, expected = 0, {}
    for row in sorted(rows, key=place):
        total += row[3]
        expected[row[2]] = total
    assert {r["id"]: r["total"] for r in rolled.collect()} == expected


@pytest.mark.parametrize("rows_per_slice", [1000, 1])
def test_an_order_that_is_no_number_is_an_error_at_every_size(spark, rows_per_slice):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2)], "k BIGINT, s STRING, v BIGINT")
    with pytest.raises(TypeError, match="ordered by"):
        rolling_fold(df, ["k"], ["s"], [Fold("total", "sum", "v")], None, rows_per_slice)


@pytest.mark.parametrize("rows_per_slice", [1000, 5])
def test_many_hot_keys_are_joined_as_a_table(spark, rows_per_slice, monkeypatch):
    from hybridflow.operators import keyed

    monkeypatch.setattr(keyed, "BROADCAST_KEYS", 2)
    rows = make_rows(9)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(rolling_fold(df, ["k"], ["ts", "id"], FOLDS, None, rows_per_slice)) == brute(rows)[0]


def test_a_batch_side_that_repeats_keys_gives_a_row_per_row(spark):
    stream = spark.createDataFrame([(1, START, 1, 5), (2, START, 2, 6)], SCHEMA)
    batch = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n"), (None, "m")], "k BIGINT, a STRING")
    joined = enrich(stream, batch, ["k"], ["ts", "id"], FOLDS).select("id", "a").collect()
    assert sorted(map(tuple, joined)) == [(1, "y"), (2, None)]
    kept = snapshot(stream, batch, ["k"], [Fold("n", "count")]).select("k", "n", "a").collect()
    assert sorted(map(str, map(tuple, kept))) == ["(1, 1, 'y')", "(2, 1, None)", "(None, 0, 'm')", "(None, 0, 'n')"]


@pytest.mark.parametrize("rows_per_slice", [1000, 20])
def test_last_value_by_its_own_order(spark, rows_per_slice):
    """Also where a key is sliced, where the order is null or ties, and where totals of parts merge."""
    rng = random.Random(9)
    rows = [(1 if i % 3 else i % 5, i, rng.choice([None, *range(20)]), rng.choice([None, *range(9)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k BIGINT, id BIGINT, at BIGINT, v BIGINT")
    folds = [Fold("latest", "last", "v", ("at",)), Fold("n", "count")]
    rolled = with_values(rolling_fold(df, ["k"], ["id"], folds, None, rows_per_slice), folds)
    held, expected = {}, {}
    for k, i, at, v in rows:
        if v is not None:
            held[k] = max(held.get(k, ((False,), -1)), ((at is not None, at) if at is not None else (False,), v))
        expected[i] = held[k][1] if k in held else None
    assert {r["id"]: r["latest"] for r in rolled.collect()} == expected
    parts = [fold_totals(df.where(f"id % 2 = {i}"), ["k"], folds) for i in (0, 1)]
    both = with_values(merge_totals(parts[0], parts[1], ["k"], folds), folds)
    assert {r["k"]: r["latest"] for r in both.collect()} == {k: v for k, (_, v) in held.items()}
