"""Windowed counts against plain Python."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hybridflow.operators.rolling import Fold
from hybridflow.operators.windows import sliding_counts, trailing_counts, windowed_fold

START = datetime(2024, 1, 1, 23, 55)
EPOCH = int(START.replace(tzinfo=timezone.utc).timestamp())


@pytest.fixture(scope="module")
def occurrences():
    rng = random.Random(1)
    return [(rng.choice("aaab"), rng.randrange(1500)) for _ in range(400)]


@pytest.fixture(scope="module")
def words(spark, occurrences):
    rows = [(w, START + timedelta(seconds=s)) for w, s in occurrences]
    return spark.createDataFrame(rows, "word STRING, ts TIMESTAMP")


@pytest.mark.parametrize("chunk_seconds", [300, 1000, 86_400])
def test_trailing_counts(words, occurrences, chunk_seconds):
    counts = trailing_counts(words, length=300, chunk_seconds=chunk_seconds)
    found = {(r[0], r[1] - EPOCH): r[2] for r in counts.select("word", F.unix_seconds("at"), "n").collect()}
    expected = {
        (w, s): sum(1 for x, t in occurrences if x == w and s - 300 < t <= s) for w, s in occurrences
    }
    assert found == expected


def test_trailing_chunk_must_hold_a_window(words):
    with pytest.raises(ValueError):
        trailing_counts(words, length=300, chunk_seconds=60)


@pytest.mark.parametrize("slide", [1, 60])
def test_sliding_counts(words, occurrences, slide):
    counts = sliding_counts(words, length=300, slide=slide)
    found = {(r[0], r[1] - EPOCH): r[2] for r in counts.select("word", F.unix_seconds("w_end"), "n").collect()}
    expected = Counter()
    for w, s in occurrences:
        for i in range(1, 300 // slide + 1):
            expected[(w, (s // slide + i) * slide)] += 1
    assert found == dict(expected)


@pytest.mark.parametrize(("length", "slide"), [(300, 70), (60, 90), (7, 3), (300, 300)])
def test_any_length_and_slide(spark, length, slide):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), START + timedelta(seconds=s), s) for s in (rng.randrange(900) for _ in range(200))]
    df = spark.createDataFrame([*rows, ("a", None, 5)], "k STRING, ts TIMESTAMP, v BIGINT")
    folds = [Fold("n", "count"), Fold("total", "sum", "v"), Fold("low", "min", "v")]
    found = windowed_fold(df, ["k"], folds, length=length, slide=slide)
    got = {(r["e"], r["k"]): (r["n"], r["total"], r["low"]) for r in found.select("*", F.unix_seconds("w_end").alias("e")).collect()}
    expected = {}
    for end in range((EPOCH // slide) * slide, EPOCH + 900 + length + slide, slide):
        for k in "ab":
            inside = [v for x, _, v in rows if x == k and end - length <= EPOCH + v < end]
            if inside:
                expected[(end, k)] = (len(inside), sum(inside), min(inside))
    assert got == expected
