"""User functions over partitions of a table, and text with ends of its own."""

import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from hybridflow.functions.table_functions import FlatMap, connected, flat_map_table, register
from hybridflow.sources.text import numbered_lines, read_clean_lines, read_lines

# Workers cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Running(FlatMap):
    """Sums so far of a partition, and their number at its end."""

    def open(self):
        self.total, self.n = 0, 0

    def flat_map(self, row):
        self.total += row["v"] or 0
        self.n += 1
        yield row["k"], self.total, None

    def close(self):
        yield None, self.total, self.n


def test_state_of_a_partition_in_order(spark):
    rows = [("a", 3, 30), ("a", 1, 10), ("b", 1, 5), ("a", 2, None), ("b", 0, 1), (None, 0, 7)]
    df = spark.createDataFrame(rows, "k STRING, t INT, v INT").repartition(3)
    got = [tuple(r) for r in flat_map_table(df, Running, "k STRING, total BIGINT, n BIGINT", ["k"], ["t"]).collect()]
    assert Counter(got) == Counter(
        [("a", 10, None), ("a", 10, None), ("a", 40, None), (None, 40, 3), ("b", 1, None), ("b", 6, None), (None, 6, 2), (None, 7, None), (None, 7, 1)]
    )


def test_in_sql(spark):
    spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "k STRING, t INT, v INT").createOrReplaceTempView("running_rows")
    register(spark, "running_sums", Running, "k STRING, total BIGINT, n BIGINT")
    found = spark.sql("SELECT * FROM running_sums(TABLE(running_rows) PARTITION BY k ORDER BY t) WHERE n IS NULL")
    assert sorted(r["total"] for r in found.collect()) == [1, 3]


class Named(FlatMap):
    def open(self):
        self.name, self.n = None, 0

    def flat_map(self, row):
        if row["side"] == 0:
            self.name = row["name"]
        else:
            self.n += 1
            yield row["k"], row["v"], self.name, self.n


def test_a_hot_key_is_dealt_over_its_salts(spark):
    """A third of the rows under one key; every row meets its batch row, and no partition holds more than a share."""
    stream = spark.createDataFrame([(1 if v % 3 == 0 else 2 + v, v) for v in range(600)] + [(None, 5000)], "k BIGINT, v BIGINT")
    batch = spark.createDataFrame([(1, "one"), (3, "three"), (None, "none")], "k BIGINT, name STRING")
    both = connected(stream, batch, ["k"], salts=8)
    got = flat_map_table(both, Named, "k BIGINT, v BIGINT, name STRING, n INT", ["k", "salt"], ["side", "v"]).collect()
    assert sorted(r["v"] for r in got) == [*range(600), 5000]
    assert {r["name"] for r in got if r["k"] == 1} == {"one"} and {r["name"] for r in got if r["k"] is None} == {None}
    assert {(r["v"], r["name"]) for r in got if r["name"] == "three"} == {(1, "three")}
    assert max(r["n"] for r in got) < 2 * 200 / 8


@pytest.mark.parametrize("end", ["\n", ";", "<>", "\x1e\n"])
def test_lines_with_ends_of_their_own(spark, tmp_path, end):
    texts = ["one\r", "", "t;w>o" if end == "<>" else "two", "three\r"]
    (tmp_path / "a.txt").write_text(end.join(texts), newline="")
    assert [r[0] for r in read_lines(spark, str(tmp_path), end).collect()] == texts
    clean = [t.removesuffix("\r") for t in texts] if end == "\n" else texts
    assert [r[0] for r in read_clean_lines(spark, str(tmp_path), end).collect()] == clean
    numbered = numbered_lines(spark, str(tmp_path), end).orderBy("line_no")
    assert [(r["line_no"], r["value"]) for r in numbered.collect()] == list(enumerate(texts, 1))


def test_no_lines_no_numbers(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    assert numbered_lines(spark, str(tmp_path)).count() == 0
    assert numbered_lines(spark, str(tmp_path)).agg(F.max("line_no")).first()[0] is None
