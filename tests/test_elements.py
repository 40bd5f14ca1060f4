"""The small worked examples on 1, 2, 3, 4, and Python functions."""

import pytest
from pyspark.sql import functions as F

from hybridflow.functions import python_udf
from hybridflow.functions.records import parity
from hybridflow.operators.keyed import key_by, random_spread, totals_by_key, totals_per_batch
from hybridflow.operators.rolling import Fold, rolling_fold
from hybridflow.sources.tables import inline_elements
from hybridflow.streaming.sinks import first_rows


def values(df):
    return sorted(r[0] for r in df.collect())


def numbers(spark):
    return inline_elements(spark, [1, 2, 3, 4])


def pairs(spark):
    return numbers(spark).select(parity(F.col("value")).alias("key"), "value")


def test_map(spark):
    assert values(numbers(spark).select(F.col("value") * 2)) == [2, 4, 6, 8]


def test_flat_map(spark):
    assert values(numbers(spark).select(F.explode(F.array(F.col("value") * 2)))) == [2, 4, 6, 8]


def test_filter(spark):
    assert values(numbers(spark).where(F.col("value") != 3)) == [1, 2, 4]


def test_filter_drops_null(spark):
    rows = inline_elements(spark, [(1,), (None,), (3,)])
    assert values(rows.where(F.col("value") != 3)) == [1]


def test_parity_of_negative_numbers(spark):
    rows = inline_elements(spark, [-3, -2]).select(parity(F.col("value")))
    assert [r[0] for r in rows.collect()] == ["odd", "even"]


def test_reduce_per_batch(spark):
    assert set(map(tuple, totals_by_key(pairs(spark), ["key"], "value").collect())) == {("even", 6), ("odd", 4)}
    halves = totals_per_batch(pairs(spark), F.col("value") <= 2, ["key"], "value")
    assert set(map(tuple, halves.collect())) == {
        (True, "odd", 1), (True, "even", 2), (False, "odd", 3), (False, "even", 4)
    }


def test_rolling_reduce_emits_every_update(spark):
    rolled = rolling_fold(pairs(spark), ["key"], ["value"], [Fold("total", "sum", "value")])
    found = [(r["key"], r["total"]) for r in rolled.orderBy("value").collect()]
    assert found == [("odd", 1), ("even", 2), ("odd", 4), ("even", 6)]


def test_first_rows(spark):
    rows = spark.range(100).select((99 - F.col("id")).alias("id"))
    assert [r[0] for r in first_rows(rows, ["id"]).collect()] == list(range(10))


def test_key_by_keeps_keys_together(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    where = key_by(rows, ["k"], "id", shares=1, partitions=5).select("k", F.spark_partition_id().alias("p"))
    assert where.distinct().count() == 7


@pytest.mark.parametrize("n", [30, 3000])
def test_key_by_shares_out_every_key_at_every_size(spark, n):
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("k"), "id")
    keyed = key_by(rows, ["k"], "id", shares=4, partitions=8)
    assert keyed.count() == n and keyed.columns == ["k", "id", "share"]
    places = keyed.select("k", "share", F.spark_partition_id().alias("p")).distinct()
    assert places.count() == places.select("k", "share").distinct().count() <= 12
    if n == 3000:
        assert keyed.groupBy("k", "share").count().agg(F.max("count")).first()[0] < 400


def test_random_spread(spark):
    spread = random_spread(spark.range(1000), 10)
    sizes = [r[0] for r in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 10 and sum(sizes) == 1000 and max(sizes) <= 110


def test_python_functions(spark):
    double = python_udf.map_values(lambda v: v * 2, "int")
    assert values(numbers(spark).select(double(F.col("value")))) == [2, 4, 6, 8]
    twice = python_udf.flat_map_values(lambda n: [n] * (n % 3), "int")
    assert values(numbers(spark).select(twice(F.col("value")))) == [1, 2, 2, 4]
    keep = python_udf.filter_values(lambda v: v != 3)
    assert values(numbers(spark).where(keep(F.col("value")))) == [1, 2, 4]


def test_python_reduce(spark):
    rows = spark.range(0, 20_000, 1, 6).select((F.col("id") % 3).alias("k"), "id")
    largest = python_udf.reduce_by_key(rows, "k", "id", max, branches=4)
    assert set(map(tuple, largest.collect())) == {(0, 19_998), (1, 19_999), (2, 19_997)}


def test_python_reduce_keeps_large_numbers_and_null_keys(spark):
    big = 2**62 + 1
    rows = spark.createDataFrame([(big, big), (None, 1), (None, 2), (big, 1)], "k BIGINT, v BIGINT")
    found = python_udf.reduce_by_key(rows, "k", "v", lambda a, b: a + b)
    assert set(map(tuple, found.collect())) == {(big, big + 1), (None, 3)}
