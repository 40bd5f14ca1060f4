"""Scores, gradients, sampling and the training loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hybridflow.functions.sampling import sample_rows
from hybridflow.operators.learn import Gradient, error_rate, gradient, score, stepped
from hybridflow.sources.text import history_ready
from hybridflow.streaming.model_store import ModelStore
from hybridflow.streaming.training import HybridTrainer, Settings

SCHEMA = "label DOUBLE, features ARRAY<DOUBLE>"
D = 3


def data(seed, n=60):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, D))
    y = (x @ np.array([1.0, -2.0, 0.5]) + rng.normal(size=n) > 0).astype(float)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(float(b), [float(v) for v in a]) for a, b in zip(x, y)], SCHEMA)


def prob(x, w):
    return 1 / (1 + np.exp(-(x @ w)))


def np_gradient(x, y, w):
    return ((prob(x, w) - y)[:, None] * x).mean(axis=0)


def np_loss(x, y, w):
    p = prob(x, w)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def test_gradient_and_error(spark):
    (x, y), w = data(1), np.array([0.3, 0.1, -0.2])
    g = gradient(frame(spark, x, y), list(w))
    assert g.n == 60
    assert g.values == pytest.approx(list(np_gradient(x, y, w)))
    assert g.error == pytest.approx(np_loss(x, y, w))
    wrong = gradient(frame(spark, x, y), list(w), "misclassified").error
    assert wrong == pytest.approx(((prob(x, w) >= 0.5) != (y >= 0.5)).mean())
    for metric, value in (("log_loss", g.error), ("misclassified", wrong)):
        assert error_rate(frame(spark, x, y), list(w), metric).first()[0] == pytest.approx(value)


def test_gradient_without_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert gradient(empty, [0.0] * D) == Gradient(0, None, None)
    assert stepped([1.0, 2.0], Gradient(0, None, None), 0.5) == [1.0, 2.0]


def test_rows_that_cannot_teach_are_set_aside_and_counted(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1.0, [1.0, 2.0, 3.0]), (0.0, [0.5, 0.0, -1.0])]
    bad = [(None, [1.0, 1.0, 1.0]), (1.0, None), (1.0, [1.0]), (1.0, [1.0, None, 1.0]), (nan, [1.0] * 3), (1.0, [1.0, inf, 1.0])]
    weights = [0.1] * D
    clean, mixed = spark.createDataFrame(good, SCHEMA), spark.createDataFrame(good + bad, SCHEMA)
    g, h = gradient(clean, weights), gradient(mixed, weights)
    assert (h.n, h.n_invalid) == (2, 6) and h.values == pytest.approx(g.values) and h.error == pytest.approx(g.error)
    for metric in ("log_loss", "misclassified"):
        rate = error_rate(mixed, weights, metric).first()
        assert (rate["n"], rate["n_invalid"]) == (2, 6)
        assert rate["error_rate"] == pytest.approx(error_rate(clean, weights, metric).first()["error_rate"])
    assert gradient(spark.createDataFrame(bad, SCHEMA), weights) == Gradient(0, None, None, 6)


def test_model_keys_may_hold_anything(spark, tmp_path):
    from hybridflow.streaming.model_store import ModelStore

    store = ModelStore(spark, str(tmp_path / "models"))
    for key in ("a/b=c", "plain", "d e"):
        store.push(key, 0, [1.0], None)
        store.push(key, 1, [2.0], 0.5)
    store.push("plain", 1, [3.0], 0.25)
    assert store.pull("a/b=c") == (1, [2.0], 0.5) and store.pull("d e", up_to=0) == (0, [1.0], None)
    assert store.pull("plain") == (1, [3.0], 0.25) and store.history().count() == 6


def test_score_works_on_streams(spark, tmp_path):
    x, y = data(2, 5)
    frame(spark, x, y).write.parquet(str(tmp_path / "in"))
    stream = score(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), [0.1] * D)
    query = stream.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    query.awaitTermination()
    found = sorted(r["p"] for r in spark.table("scored").collect())
    assert found == pytest.approx(sorted(prob(x, np.full(D, 0.1))))


def test_sampling(spark):
    ids = spark.range(0, 10_000, 1, 8)
    kept = sample_rows(ids, 0.3, seed=1, row_id="id")
    again = sample_rows(ids.repartition(3), 0.3, seed=1, row_id="id")
    assert 2_800 < kept.count() < 3_200
    assert kept.exceptAll(again).count() == again.exceptAll(kept).count() == 0
    assert sample_rows(ids, 0.3, seed=2, row_id="id").intersect(kept).count() < 1_300
    assert sample_rows(ids, 1.0, row_id="id").count() == 10_000
    assert sample_rows(ids, 0.0, row_id="id").count() == 0
    assert 2_500 < sample_rows(ids, 0.3).count() < 3_500


def test_model_store(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    store.push("a", 0, [0.0], None)
    assert store.pull("a") == (0, [0.0], None)
    store.push("a", 1, [1.0], 0.5)
    store.push("a", 3, [3.0], 0.2)
    store.push("b", 2, [9.0], 0.1)
    assert store.pull("a") == (3, [3.0], 0.2)
    assert store.pull("a", up_to=2) == (1, [1.0], 0.5)
    assert store.pull("c") is None
    store.push("a", 3, [4.0], 0.3)
    assert store.pull("a") == (3, [4.0], 0.3)
    assert sorted((r["model_key"], r["version"]) for r in store.latest().collect()) == [("a", 3), ("b", 2)]


def trainer(spark, path, history, **changes):
    ready = changes.pop("ready", None)
    settings = Settings(**{"n_features": D, "rate": 0.5, "threshold": 0.6, **changes})
    made = HybridTrainer(spark, str(path), lambda: history, settings, ready)
    made.start_from()
    return made


def trace(t):
    return [tuple(r) for r in t.trace().orderBy("batch_id").select("batch_id", "action", "pushed").collect()]


def test_retraining_takes_both_steps(spark, tmp_path):
    (hx, hy), (x, y) = data(3, 200), data(4)
    t = trainer(spark, tmp_path, frame(spark, hx, hy))
    t(frame(spark, x, y), 0)
    w = -0.5 * np_gradient(x, y, np.zeros(D))
    w = w - 0.5 * np_gradient(hx, hy, w)
    version, weights, error = t.models.pull("hybrid-logistic-regression")
    assert (version, weights) == (1, pytest.approx(list(w)))
    assert error == pytest.approx(np.log(2))
    assert trace(t) == [(0, "retrain", True)]
    assert [r["error_rate"] for r in t.quality().collect()] == [error]


def test_threshold_never_reached(spark, tmp_path):
    t = trainer(spark, tmp_path, spark.createDataFrame([], SCHEMA), threshold=100.0)
    for b in range(2):
        t(frame(spark, *data(b)), b)
    assert trace(t) == [(0, "step", True), (1, "step", True)]


def test_empty_history_leaves_the_first_step(spark, tmp_path):
    x, y = data(5)
    t = trainer(spark, tmp_path, spark.createDataFrame([], SCHEMA))
    t(frame(spark, x, y), 0)
    weights = t.models.pull("hybrid-logistic-regression")[1]
    assert weights == pytest.approx(list(-0.5 * np_gradient(x, y, np.zeros(D))))


def test_empty_micro_batch(spark, tmp_path):
    t = trainer(spark, tmp_path, spark.createDataFrame([], SCHEMA))
    t(spark.createDataFrame([], SCHEMA), 0)
    assert trace(t) == [(0, "empty", False)]
    assert t.models.pull("hybrid-logistic-regression")[0] == 0


def test_buffer_holds_back_pushes_until_history_is_complete(spark, tmp_path):
    (hx, hy), path = data(6, 100), str(tmp_path / "history")
    inputs = [data(7), (np.zeros((4, D)), np.ones(4)), data(8), data(9)]
    settings = Settings(n_features=D, rate=0.5, threshold=0.6)
    t = HybridTrainer(
        spark, str(tmp_path / "t"), lambda: spark.read.schema(SCHEMA).parquet(path), settings,
        ready=lambda: history_ready(spark, path),
    )
    t.start_from()
    for b, (x, y) in enumerate(inputs):
        if b == 2:
            frame(spark, hx, hy).write.parquet(path)
        for _ in range(2):  # a micro-batch may be run again
            t(frame(spark, x, y), b)
    assert trace(t)[:3] == [(0, "buffer", False), (1, "buffer", False), (2, "retrain", True)]
    assert trace(t)[3][2]
    w = -0.5 * np_gradient(*inputs[2], np.zeros(D))
    mx = np.vstack([hx, inputs[0][0], inputs[1][0]])
    my = np.concatenate([hy, inputs[0][1], inputs[1][1]])
    w = w - 0.5 * np_gradient(mx, my, w)
    version, weights, _ = t.models.pull("hybrid-logistic-regression", up_to=3)
    assert (version, weights) == (3, pytest.approx(list(w)))


def test_sampled_history(spark, tmp_path):
    (hx, hy), (x, y) = data(10, 300), data(11)
    history = frame(spark, hx, hy).withColumn("id", F.monotonically_increasing_id())
    t = trainer(spark, tmp_path, history, sampling_rate=0.5, row_id="id", seed=3)
    t(frame(spark, x, y), 0)
    kept = sample_rows(history, 0.5, 3, "id").collect()
    assert 100 < len(kept) < 200
    sx, sy = np.array([r["features"] for r in kept]), np.array([r["label"] for r in kept])
    w = -0.5 * np_gradient(x, y, np.zeros(D))
    w = w - 0.5 * np_gradient(sx, sy, w)
    assert t.models.pull("hybrid-logistic-regression")[1] == pytest.approx(list(w))
