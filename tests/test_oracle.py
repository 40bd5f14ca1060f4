"""Every registered query against DuckDB SQL on the same tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as contract

QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, SQL[name]) == ""


def test_entry_has_a_row_per_event(spark, folder):
    assert contract.entry(spark).count() == spark.read.parquet(f"{folder}/events.parquet").count()


@pytest.mark.parametrize(
    "name",
    [
        "reduce_rolling",
        "reduce_rolling_stream",
        "hybrid_join_enrich",
        "hybrid_join_enrich_orders",
        "hybrid_join_full",
        "hybrid_join_full_stream",
    ],
)
def test_same_rows_if_every_key_is_hot(spark, folder, con, monkeypatch, name):
    """The queries once more, with slices of a few rows."""
    from hybridflow.operators import keyed, rolling

    monkeypatch.setattr(rolling, "hot_keys", lambda counts, _: keyed.hot_keys(counts, 9))
    sliced = rolling._sliced
    monkeypatch.setattr(rolling, "_sliced", lambda *args: sliced(*args[:-1], 40))
    assert differences(QUERIES[name](spark, folder), con, SQL[name]) == ""
