"""What Spark makes of the operators: shuffles, pushed filters, columns read."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from hybridflow.functions.words import words_of
from hybridflow.operators.hybrid_join import enrich, full, snapshot
from hybridflow.operators.keyed import totals_by_key
from hybridflow.operators.rolling import Fold, rolling_fold
from hybridflow.plans import all_queries
from hybridflow.sources.tables import table

FOLDS = [Fold("n", "count"), Fold("total", "sum", "value")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark, folder):
    return table(spark, folder, "events").select(F.col("user_id").alias("k"), "ts", "event_id", "value")


def customers(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_enrich_shuffles_the_stream_once(spark, folder, no_broadcast):
    plan = plan_of(enrich(events(spark, folder), customers(spark, folder), ["k"], ["ts", "event_id"], FOLDS))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_sliced_fold_broadcasts_hot_keys_only(spark, folder, no_broadcast):
    rows = events(spark, folder)
    plan = plan_of(rolling_fold(rows, ["k"], ["ts", "event_id"], FOLDS, customers(spark, folder), 20))
    sizes = re.findall(r"BroadcastExchange.*?\n(?:.*\n){0,3}.*?(Scan ExistingRDD|FileScan|LocalTableScan)", plan)
    assert sizes and "FileScan" not in sizes
    stream_shuffles = re.findall(r"Exchange hashpartitioning\(_key0#\d+L?, _null0#\d+, _slice#", plan)
    assert len(stream_shuffles) >= 2


def test_cutoff_reaches_the_scan(spark, folder):
    joined = full(events(spark, folder), customers(spark, folder), ["k"], ["ts", "event_id"], FOLDS, "2024-01-15")
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", plan_of(joined))
    assert any("GreaterThanOrEqual(ts" in p for p in pushed)
    assert any("LessThan(ts" in p for p in pushed)


def test_only_needed_columns_are_read(spark, folder):
    plan = plan_of(snapshot(events(spark, folder), customers(spark, folder), ["k"], FOLDS))
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan
    assert "c_name" not in plan


def test_totals_are_combined_before_the_shuffle(spark, folder):
    plan = plan_of(totals_by_key(events(spark, folder), ["k"], "value"))
    assert "partial_sum" in plan


def test_words_stay_in_the_jvm(spark, folder):
    plan = plan_of(words_of(table(spark, folder, "documents"), "text"))
    assert "Generate explode" in plan and "Python" not in plan


def test_days_outside_the_window_are_pruned(spark, folder, tmp_path):
    from hybridflow.sources.daily import in_window, write_by_day

    write_by_day(table(spark, folder, "events").select(F.to_date("ts").alias("file_date"), "event_id"), str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t")).where(in_window(F.col("file_date"), date(2024, 1, 30), 8))
    assert re.search(r"PartitionFilters: \[.*file_date", plan_of(read))


@pytest.mark.parametrize(
    "name", ["hybrid_join_enrich", "hybrid_join_full", "hybrid_join_snapshot", "wordcount_total", "wordcount_trailing"]
)
def test_no_cross_joins(spark, folder, name):
    plan = plan_of(all_queries()[name](spark, folder))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan
