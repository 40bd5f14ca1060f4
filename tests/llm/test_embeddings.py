import brute
import numpy as np
import pandas as pd
import pytest

from hybridflow.llm.embedding_dedup import Shard, _build, linked, local_roots, near_vectors, planted
from hybridflow.llm.hnsw import Graph

VECTORS = "vec_id long, embedding array<float>, label int, node long, shard int"


def clusters(n, size, seed, noise=0.08, dim=32):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    return (np.repeat(base, size, axis=0) + rng.normal(size=(n * size, dim)) * noise * rng.random((n * size, 1)) * 3).astype(np.float32)


def brute_links(rows, cosine=0.98):
    fine = [
        (i, np.array(v, dtype=np.float64), label)
        for i, v, label in rows
        if v is not None and label is not None and len(v) and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)
    ]
    for k, (i, a, p) in enumerate(fine):
        for j, b, q in fine[k + 1 :]:
            if p == q and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                yield i, j


@pytest.mark.parametrize("shard_rows", [10_000, 40])
def test_links_and_components_as_brute_force(spark, shard_rows):
    x = clusters(30, 6, 1)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)] + [(500 + i, x[0].tolist(), 0) for i in range(5)]
    links = list(brute_links(rows))
    want = brute.groups([r[0] for r in rows], links)
    count = {r[0]: sum(r[0] in p for p in links) for r in rows}
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS).repartition(3)
    got = {r["vec_id"]: r for r in near_vectors(table, shard_rows=shard_rows).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_links"] for i, r in got.items()} == count
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_recall_of_the_graph_with_dense_groups():
    x = clusters(40, 50, 2, noise=0.03)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, node = Graph.build(x).within(x, 0.98, 32, 0.005)
    exact = x @ x.T >= 0.98
    assert exact[row, node].all() and len(set(zip(row.tolist(), node.tolist(), strict=True))) >= 0.9 * exact.sum()  # unwidened


def shard_of(x):
    rows = pd.DataFrame({"node": np.arange(len(x)), "copies": 1, "v": list(x)})
    return Shard(_build((0, x.shape[1], 0), rows).iloc[0].to_dict())


def sparse_pairs(n, seed=3, dim=32, spread=0.14, size=50):
    """Rows of which one in 10 of the second part, never one the audit takes, is near one of the first."""
    rng = np.random.default_rng(seed)

    def unit(v):
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    centres = np.repeat(unit(rng.normal(size=(n // size, dim))), size, axis=0)
    x = unit(centres + spread * unit(rng.normal(size=centres.shape)))
    y = unit(rng.normal(size=x.shape))
    at = np.arange(3, n, 10)
    y[at] = planted(x[at], 0.981)
    return x, y


def test_sparse_pairs_that_no_audited_row_has():
    x, y = sparse_pairs(4000)
    p, q = shard_of(x), shard_of(y)
    exact = q.unit @ p.unit.T >= 0.98
    assert exact.sum() > 400 and not exact[::50].any()
    for beam in (1, 32):
        row, node = linked(q, p, 0.98, 0.995, beam=beam)
        assert exact[row, node].all() and len(row) >= 0.995 * exact.sum(), beam


def test_planted_vectors_keep_their_distance():
    x = shard_of(clusters(20, 50, 4)).unit
    rows = np.unique(np.linspace(0, 999, 600).astype(int))
    assert np.allclose((planted(x, 0.98) * x[rows]).sum(axis=1), 0.98)
    assert planted(np.array([[1.0], [-1.0]]), 0.98).tolist() == [[1.0], [-1.0]]


def test_local_roots():
    assert local_roots(6, np.array([5, 3]), np.array([4, 5])).tolist() == [0, 1, 2, 3, 3, 3]
    assert local_roots(0, np.empty(0, int), np.empty(0, int)).tolist() == []


def test_odd_rows_and_empty_table(spark):
    nan = float("nan")
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, nan], 0), (4, [1.0, None], 0), (5, [1.0, 0.0], None), (6, [1.0, 0.0], 0), (7, [2.0, 0.0], 0), (8, [], 0),
            (None, [1.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (10, [float("inf"), 0.0], 0), (11, [-1.0, 0.0], 0), (12, [0.5, 0.5], 3), (12, [0.5, 0.5], 3)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS)
    got = near_vectors(table).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None}
    assert all(by[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 8, 9, 10, 11))
    assert by[6] == (2, 6, True) and by[7] == (2, 6, False) and by[12] == (1, 12, True)
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
