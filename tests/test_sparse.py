"""Sparse models against the dense way and plain numpy."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hybridflow.operators import sparse
from hybridflow.operators.learn import gradient, stepped
from hybridflow.plans import learning

SCHEMA = "label DOUBLE, indices ARRAY<BIGINT>, values ARRAY<DOUBLE>"


def as_dict(weights):
    return {r["j"]: r["w"] for r in weights.collect()}


def plain(rows, steps, rate):
    w = {}
    for _ in range(steps):
        g = {}
        for y, js, xs in rows:
            z = sum(w.get(j, 0.0) * x for j, x in zip(js, xs, strict=True))
            for j, x in zip(js, xs, strict=True):
                g[j] = g.get(j, 0.0) + (1 / (1 + np.exp(-z)) - y) * x
        w = {j: w.get(j, 0.0) - rate * g.get(j, 0.0) / len(rows) for j in {*w, *g}}
    return w


def test_same_weights_as_the_dense_way(spark):
    rng = random.Random(1)
    data = [(float(rng.random() < 0.4), [rng.gauss(0, 1) for _ in range(64)]) for _ in range(300)]
    dense = spark.createDataFrame(data, "label DOUBLE, features ARRAY<DOUBLE>").repartition(4)
    rows = dense.select("label", F.sequence(F.lit(0), F.lit(63)).alias("indices"), F.col("features").alias("values"))
    weights = [0.0] * 64
    for _ in range(3):
        weights = stepped(weights, gradient(dense, weights), 0.5)
    got, losses = sparse.train(rows, 3, 0.5, block_features=7)
    assert np.allclose([as_dict(got)[j] for j in range(64)], weights, atol=1e-12)
    assert losses == sorted(losses, reverse=True) and abs(losses[0] - np.log(2)) < 1e-12


@pytest.mark.parametrize("group_rows, block", [(3, 1000), (4096, 1 << 16), (10, 250_000)])
def test_a_million_features_and_one_in_every_row(spark, group_rows, block):
    rng = random.Random(2)
    rows = []
    for _ in range(200):
        js = [999_999, *[rng.randrange(1_000_000) if rng.random() < 0.5 else rng.randrange(40) for _ in range(12)]]
        rows.append((float(rng.random() < 0.5), js, [1.0, *[rng.gauss(0, 1) for _ in range(12)]]))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got, _ = sparse.train(frame, 3, 0.8, block_features=block, group_rows=group_rows)
    expected = plain(rows, 3, 0.8)
    found = as_dict(got)
    assert set(found) == set(expected)
    assert all(abs(found[j] - expected[j]) < 1e-12 for j in expected)


def test_rows_that_cannot_teach(spark):
    nan = float("nan")
    good = [(1.0, [1, 1, 5], [0.5, 0.25, 1.0]), (0.0, [5], [2.0]), (1.0, [], [])]
    bad = [(None, [1], [1.0]), (nan, [1], [1.0]), (1.0, None, [1.0]), (1.0, [1], None), (1.0, [1, 2], [1.0]), (1.0, [None], [1.0]),
           (1.0, [1], [None]), (1.0, [1], [nan]), (1.0, [-1], [1.0])]
    got, losses = sparse.train(spark.createDataFrame(good + bad, SCHEMA), 2, 1.0)
    expected = plain(good, 2, 1.0)
    assert as_dict(got) == pytest.approx(expected) and len(losses) == 2


def test_starting_from_given_weights_and_no_rows(spark):
    start = spark.createDataFrame([(3, 0.5), (10**9, -1.0)], "j BIGINT, w DOUBLE")
    same, losses = sparse.train(spark.createDataFrame([], SCHEMA), 2, 1.0, start)
    assert as_dict(same) == {3: 0.5, 10**9: -1.0} and losses == []
    got, _ = sparse.train(spark.createDataFrame([(1.0, [3], [2.0])], SCHEMA), 1, 1.0, start)
    assert as_dict(got) == pytest.approx({3: 0.5 + 2 * (1 - 1 / (1 + np.exp(-1.0))), 10**9: -1.0})


def test_groups_close_early_on_long_rows(spark, monkeypatch):
    monkeypatch.setattr(sparse, "GROUP_ENTRIES", 10)
    rows = [(float(i % 2), list(range(i, i + 8)), [1.0] * 8) for i in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert sparse.tiles_of(frame).select("grp").distinct().count() == 15
    got, _ = sparse.train(frame, 2, 0.3)
    assert as_dict(got) == pytest.approx(plain(rows, 2, 0.3))


def test_a_feature_that_a_row_repeats_is_one_entry(spark):
    rows = [(1.0, [5, 1, 5, 5], [0.5, 1.0, 0.25, 0.25]), (0.0, [], []), (0.0, [1, 1], [2.0, 1.0])]
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    tile = sparse.tiles_of(frame).where("block <> -1").collect()
    assert [(t["rows"], t["features"], t["x"]) for t in tile] == [([0, 2, 0], [1, 1, 5], [1.0, 3.0, 1.0])]
    got, _ = sparse.train(frame, 2, 0.7)
    assert as_dict(got) == pytest.approx(plain(rows, 2, 0.7))


def test_words_of_labelled_documents_are_not_exploded(spark, tmp_path):
    """Repeated ids are one document; no text, blanks only, no label and no id teach nothing."""
    texts = [(1, "a b a\n\nb  c  "), (2, "c c"), (1, "d a"), (3, "   "), (4, None), (5, "a z"), (6, "q"), (None, "a"), (7, "")]
    labels = [(1, 1), (2, 0), (3, 1), (4, 0), (6, None), (None, 1), (7, 0)]
    spark.createDataFrame(texts, "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT").write.parquet(str(tmp_path / "labels.parquet"))
    words = {1: (1.0, ["a", "b", "a", "", "b", "", "c", "d", "a"]), 2: (0.0, ["c", "c"]), 7: (0.0, [""])}
    rows = [(y, [int(hashlib.md5(w.encode()).hexdigest()[:5], 16) for w in ws], [1 / len(ws)] * len(ws)) for y, ws in words.values()]
    plans = []
    train = learning.train

    def seen(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return train(rows, *args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(learning, "train", seen)
        got = learning.lr_sparse_steps(spark, str(tmp_path))
    assert as_dict(got) == pytest.approx(plain(rows, learning.SPARSE_STEPS, learning.SPARSE_RATE), abs=1e-9)
    assert "Generate" not in plans[0]


def test_tiles_are_read_few_at_once(spark, monkeypatch):
    """Thousands of tiles in a batch fill a task's memory; the session's own settings come back, also after an error."""
    before, seen, residuals = {n: spark.conf.get(n) for n in sparse.LARGE_ROWS}, [], sparse.residuals

    def watched(*args):
        seen.append({n: spark.conf.get(n) for n in sparse.LARGE_ROWS})
        return residuals(*args)

    monkeypatch.setattr(sparse, "residuals", watched)
    frame = spark.createDataFrame([(1.0, [3], [2.0])], SCHEMA)
    sparse.train(frame, 1, 1.0)
    assert seen == [sparse.LARGE_ROWS] != [before] and {n: spark.conf.get(n) for n in before} == before
    monkeypatch.setattr(sparse, "residuals", None)
    with pytest.raises(TypeError):
        sparse.train(frame, 1, 1.0)
    assert {n: spark.conf.get(n) for n in before} == before
