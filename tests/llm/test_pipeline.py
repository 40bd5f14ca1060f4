import random

import brute
import pytest
from brute import prose

import corpus_pipeline
from hybridflow.llm.common import Cuts


@pytest.fixture(scope="module")
def corpus(spark, docs_of):
    """Documents with every kind of thing that a stage removes, and the tables the stages read."""
    rng = random.Random(9)
    clean = [(i, "\n".join(prose(rng, 12) for _ in range(6)), f"s{i % 3}") for i in range(60)]
    items = [(i, prose(rng, 40)) for i in range(5)]
    rows = list(clean)
    toxic = [(100 + i, f"you idiot {prose(rng, 30)} moron scum {prose(rng, 5)}", "s0") for i in range(40)]
    rows += toxic
    rows += [(200 + i, clean[i][1], "s1") for i in range(4)]  # exact copies
    passage = "\n".join(prose(rng, 20) for _ in range(4))
    rows += [(300 + i, f"{prose(rng, 60)}\n{passage}\n{prose(rng, 60)}", "s2") for i in range(5)]
    near = prose(rng, 150).split()
    for i in range(4):
        words = list(near)
        words[10 + i] = "changed"
        rows.append((400 + i, " ".join(words), "s2"))
    rows += [(500 + i, f"{prose(rng, 50)} {items[i][1]} {prose(rng, 50)}", "s1") for i in range(5)]
    folder = Cuts(spark, "pipeline-test").root
    docs_of(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(r[0], 1, 1 if 100 <= r[0] < 200 else 0) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, items


def test_as_brute_force(spark, corpus):
    folder, rows, items = corpus
    left = [(i, t) for i, t, _ in rows if not 100 <= i < 200]
    before = dict(left)
    texts = {i: t for i, t in brute.line_dedup(left).items() if t.strip() or not before[i].strip()}
    sets = {i: brute.shingles(t, 5) for i, t in texts.items()}
    root = brute.groups(sets, brute.near_pairs(sets, 80))
    texts = {i: t for i, t in texts.items() if root[i] == i}
    want = {i: t for i, t in texts.items() if not any(item in t for _, item in items)}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == set(want)
    assert {i: r["size"] for i, r in got.items()} == {i: len(t.split()) for i, t in want.items()}
    assert set(range(60)) <= set(got)


def test_stages_keep_the_columns_of_documents(spark, corpus, docs_of):
    folder, *_ = corpus
    cuts = Cuts(spark, "stages")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = cuts.cut(stage(spark, kept, folder))
        assert kept.dtypes == docs.dtypes
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
