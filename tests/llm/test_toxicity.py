import random

import numpy as np
import pytest
from brute import prose

from hybridflow.llm import toxicity

LABELS = "doc_id long, quality int, toxic int, tag string"


@pytest.fixture(scope="module")
def scorer(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.fit(docs, labels), docs, labels


def test_held_out_accuracy(scorer):
    fitted, docs, labels = scorer
    out = toxicity.score_documents(docs, fitted).toPandas().merge(labels.toPandas(), on="doc_id")
    out = out[out.held_out]
    right = ((out.score >= 0.5).astype(int) == out.toxic).mean()
    assert right > 0.9 and (out.predicted == (out.score >= 0.3)).all()
    assert out[out.toxic == 0].predicted.mean() < 0.05


def test_held_out_rows_teach_nothing(spark, docs_of):
    """Their labels may say anything."""
    rng = random.Random(1)
    rows = [(i, prose(rng, 30) + (" zzgrmbl" if i % 4 == 0 else "")) for i in range(200)]
    docs = docs_of(rows)
    out = toxicity.held_out
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0), "x") for i in range(200)], LABELS)
    wrong = labels.withColumn("toxic", (labels.toxic + out(labels.doc_id).cast("int")) % 2)
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, wrong)
    assert (a.codes == b.codes).all() and np.allclose(a.weights, b.weights) and a.bias == b.bias
    got = toxicity.score_documents(docs, a).toPandas()
    assert (got.predicted == (got.doc_id % 4 == 0)).mean() > 0.97


def test_the_label_model_finds_accuracies_and_a_dependence():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.2
    fires = np.stack([rng.random(6000) < np.where(y, p, q) for p, q in ((0.9, 0.02), (0.7, 0.05), (0.6, 0.01))], axis=1)
    twin = np.where(rng.random(6000) < 0.95, fires[:, 0], ~fires[:, 0])
    votes = np.concatenate([fires, twin[:, None]], axis=1).astype(int)
    pattern, count = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_label_model(pattern, count.astype(float))
    assert abs(model.prior - 0.2) < 0.05
    assert model.parent[3] == 0 or model.parent[0] == 3
    post = model.posterior(votes)
    assert ((post > 0.5) == y).mean() > 0.95


def test_an_id_that_repeats_teaches_once(spark, docs_of):
    """A third of the rows under one labelled id: the sample is bounded in rows, and the fit is the same."""
    rng = random.Random(2)
    rows = [(i, prose(rng, 20) + (" zzgrmbl" if i % 4 == 0 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0), "x") for i in range(120)], LABELS)
    ids = toxicity.labelled_ids(labels, 50)
    one = ids.first()["id"]
    many = docs_of([*rows, *[r for r in rows if r[0] == one] * 60])
    assert toxicity.labelled_sample(many, ids).count() == 50
    a, b = toxicity.fit(docs_of(rows), labels, sample_rows=50), toxicity.fit(many, labels, sample_rows=50)
    assert (a.codes == b.codes).all() and np.allclose(a.weights, b.weights) and a.bias == b.bias
    other = docs_of([*rows, (one, "another text"), (one, None)])
    assert toxicity.labelled_sample(other, ids).count() == 50


def plain_score(fitted, text):
    """The score by looking at each word and word beginning on its own."""
    from hybridflow.llm import shingles as sh

    vocabulary = toxicity.Vocabulary(fitted.codes)
    data = np.frombuffer((text or "").encode(), np.uint8)
    found = vocabulary.of_texts(sh.words(data, np.array([0, len(data)]), letters=True), toxicity.lowered(data))
    z = fitted.bias + sum(fitted.weights[k] for own in found for k in own)
    return 1 / (1 + np.exp(-z))


def test_scores_are_the_linear_classifier_on_each_text_alone(scorer):
    fitted, docs, _ = scorer
    rows = docs.limit(80).collect()
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, fitted).collect()}
    assert all(abs(got[r["doc_id"]] - plain_score(fitted, r["text"])) < 1e-9 for r in rows)


def test_odd_rows(scorer, docs_of, odd_rows):
    fitted, *_ = scorer
    docs = docs_of([*odd_rows, (99, "You IDIOT, you moron! Stupid scum, worthless loser.")])
    rows = toxicity.score_documents(docs, fitted).collect()
    assert len(rows) == len(odd_rows) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["predicted"] for r in rows if r["doc_id"] == 99] == [1]
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] in (1, 2, 3, 4, 8))
    assert not [r["held_out"] for r in rows if r["doc_id"] is None and r["held_out"]]
    kept = toxicity.drop_toxic(docs, fitted)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], LABELS)
    docs = docs_of([(1, "idiot moron scum"), (2, "fine words"), (3, None)])
    rows = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(docs, toxicity.fit(docs, none)).collect()}
    assert rows == {1: 1, 2: 0, 3: 0}
    assert toxicity.score_documents(docs_of([]), toxicity.fit(docs_of([]), none)).count() == 0
    odd = spark.createDataFrame([(None, 1, 1, "x"), (1, None, None, None), (2, 0, 7, "x"), (3, 0, 0, "x"), (3, 0, 1, "x")], LABELS)
    assert toxicity.score_documents(docs, toxicity.fit(docs, odd)).count() == 3
