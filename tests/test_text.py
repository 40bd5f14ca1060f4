"""Lines, words and messages at their edges."""

import random

import pytest
from pyspark.sql import functions as F

from hybridflow.functions.records import (
    decode_csv,
    decode_json,
    encode_csv,
    left_side,
    map_left,
    parse_lines,
    right_side,
    split_decoded,
)
from hybridflow.functions.vectors import parse_labeled_vector, vector_add
from hybridflow.functions.words import lines_of, split_blank, strip_cr, words_of
from hybridflow.operators.connect import connect
from hybridflow.sources.text import history_ready, read_clean_lines, read_lines


def one_column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


@pytest.mark.parametrize(
    "line, words",
    [
        ("a b  ", ["a", "b"]),
        ("", [""]),
        ("   ", []),
        (" a", ["", "a"]),
        ("a  b", ["a", "", "b"]),
        ("a\tb c", ["a\tb", "c"]),
    ],
)
def test_split(spark, line, words):
    assert one_column(spark, [line]).select(split_blank(F.col("value"))).first()[0] == words


def test_split_of_random_lines(spark):
    rng = random.Random(1)
    lines = ["".join(rng.choice("ab  \t") for _ in range(rng.randrange(9))) for _ in range(500)]

    def expected(line):
        words = line.split(" ")
        while len(words) > 1 and words[-1] == "":
            words.pop()
        return [] if words == [""] and line else words

    found = one_column(spark, lines).select("value", split_blank(F.col("value")).alias("words"))
    for row in found.collect():
        assert row["words"] == expected(row["value"]), repr(row["value"])


def test_words_of_a_blank_line_are_none(spark):
    assert words_of(one_column(spark, ["  ", "x y"]), "value").count() == 2


def test_lines_of(spark):
    lines = lines_of(one_column(spark, ["a\n\nb"]), "value")
    assert [r[0] for r in lines.collect()] == ["a", "", "b"]


def test_strip_one_cr(spark):
    rows = one_column(spark, ["a\r\r", "a\r", "a", "", "\r"]).select(strip_cr(F.col("value")))
    assert [r[0] for r in rows.collect()] == ["a\r", "a", "a", "", ""]


def test_lines_end_at_newline_only(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"a\r\nb\rc\nd\r\n")
    (tmp_path / "_hidden").write_bytes(b"no\n")
    (tmp_path / ".hidden").write_bytes(b"no\n")
    assert [r[0] for r in read_lines(spark, str(tmp_path)).collect()] == ["a\r", "b\rc", "d\r"]
    assert [r[0] for r in read_clean_lines(spark, str(tmp_path)).collect()] == ["a", "b\rc", "d"]


def test_history_ready(spark, tmp_path):
    path = str(tmp_path / "h")
    assert not history_ready(spark, path)
    spark.range(3).write.parquet(path)
    assert history_ready(spark, path)


def test_decode_csv(spark):
    schema = "id BIGINT, ts TIMESTAMP, x DOUBLE"
    rows = one_column(spark, ["7,2024-01-01 00:00:00,1.5", "bad", None])
    decoded = rows.select(decode_csv(F.encode("value", "utf-8"), schema).alias("r"))
    good, bad = split_decoded(decoded, "r")
    assert [r["r"]["id"] for r in good.collect()] == [7]
    assert bad.count() == 2


def test_decode_json(spark):
    rows = one_column(spark, ['{"k": 4}', "{", None]).select(decode_json(F.col("value"), "k INT").alias("r"))
    found = [r["r"] for r in rows.collect()]
    assert found[0]["k"] == 4
    assert found[1] is None or found[1]["k"] is None
    assert found[2] is None


def test_encode_and_decode(spark):
    rows = spark.createDataFrame([(1, "a,b"), (2, 'say "x"')], "id BIGINT, s STRING")
    back = rows.select(decode_csv(encode_csv(F.struct("*")), "id BIGINT, s STRING").alias("r")).select("r.*")
    assert back.collect() == rows.collect()


def test_bad_lines_keep_their_text(spark):
    rows = parse_lines(one_column(spark, ["1,a", "x,b"]), "value", "id INT, s STRING")
    assert [(r["id"], r["_corrupt"]) for r in rows.collect()] == [(1, None), (None, "x,b")]


def test_map_left_lets_the_marker_through(spark):
    left = one_column(spark, ["a", "b"]).select(*left_side(F.col("value")))
    union = map_left(left.unionByName(right_side(left)), F.upper)
    assert [tuple(r) for r in union.collect()] == [("left", "A"), ("left", "B"), ("right", None)]


def test_connect(spark):
    both = connect(spark.createDataFrame([(1, 2.0)], "k INT, v DOUBLE"), spark.createDataFrame([(1, "x")], "k INT, a STRING"))
    assert [tuple(r) for r in both.select("side", "k", "v", "a").collect()] == [
        ("stream", 1, 2.0, None), ("batch", 1, None, "x")
    ]


def test_labeled_vectors(spark):
    rows = one_column(spark, ["1, 0.5,2", "1,0.5", "0,a,1", ""])
    found = [r[0] for r in rows.select(parse_labeled_vector(F.col("value"), 2)).collect()]
    assert (found[0]["label"], found[0]["features"]) == (1.0, [0.5, 2.0])
    assert found[1:] == [None, None, None]


def test_vector_add(spark):
    row = spark.range(1).select(
        F.array(F.lit(1.0), F.lit(2.0)).alias("a"), F.array(F.lit(0.5), F.lit(-2.0)).alias("b")
    )
    assert row.select(vector_add(F.col("a"), F.col("b"))).first()[0] == [1.5, 0.0]
    with pytest.raises(Exception, match="differ in size"):
        row.select(vector_add(F.col("a"), F.array(F.lit(1.0)))).collect()
