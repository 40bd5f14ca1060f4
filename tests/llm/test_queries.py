import pytest
from compare import differences, duck

from hybridflow.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_a_row_per_input_row(spark, folder, name):
    table = "pages" if name.startswith("op9") else "documents"
    assert QUERIES[name](spark, folder).count() == spark.read.parquet(f"{folder}/{table}.parquet").count()
