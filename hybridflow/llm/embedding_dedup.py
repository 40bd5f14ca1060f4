"""Near-duplicate embeddings: HNSW graphs per shard, audited searches, verified links, components.

1. Equal vectors of one label become one row with a count, so copies cost nothing further.
2. The vectors of a label are dealt into shards of about ``shard_rows``; each shard becomes a graph,
   written as one row. A label that holds a third of all rows is many shards.
3. Every vector is searched in every shard of its label, shard against shard; a pair of shards is
   searched once and counts for both sides. The beam and the margin of a search widen until two
   audits pass, of a fixed part of the queries and of vectors planted at ``cosine`` from rows of the
   shard: both are compared with all vectors of the shard, and at least ``recall`` of the links of
   each, without those to itself, must have been found. The widest search compares everything.
4. Candidates are verified by cosine in double precision. Per pair of shards come out the number of
   links of each vector, and one link to the component it has there; large-star and small-star
   join these.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components, or one
whose label is null, has no links and is its own component. Vectors of different length are not
compared. Rows that repeat a vec_id count as separate vectors and are one node. Among rows without
vec_id links count, but they name no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybridflow.llm.common import Cuts, ready
from hybridflow.llm.components import components
from hybridflow.llm.hnsw import Graph

COSINE = 0.98
SHARD_ROWS = 8192
RECALL = 0.995
AUDIT_EVERY = 50
#: Vectors planted in a shard for the audit: enough that no single one decides about 99.5%.
PLANTED = 600
BEAM = 32
#: Vectors a search looks at for each place of its beam, at the least.
REACH = 16
MARGIN = 0.005
NAMELESS = 1 << 62
#: Float32 products of unit vectors differ from double ones by less than this.
ROUNDING = 1e-5
QUERY_BATCH = 256


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's rows (node, copies, v) to one row with its graph."""
    raw = np.stack(rows["v"].to_numpy()).astype(np.float64)
    graph = Graph.build(unit(raw).astype(np.float32))
    return pd.DataFrame(
        [(*key, graph.entry, rows["node"].to_numpy(np.int64).tobytes(), rows["copies"].to_numpy(np.int64).tobytes(), raw.tobytes(),
          [x.astype(np.int32).tobytes() for x in graph.links])],
        columns=["label", "dim", "shard", "entry", "nodes", "copies", "raw", "links"],
    )


GRAPH = "label int, dim int, shard int, entry int, nodes binary, copies binary, raw binary, links array<binary>"


class Shard:
    def __init__(self, row: dict):
        self.nodes = np.frombuffer(row["nodes"], np.int64)
        self.copies = np.frombuffer(row["copies"], np.int64)
        self.raw = np.frombuffer(row["raw"], np.float64).reshape(len(self.nodes), -1)
        self.unit = unit(self.raw)
        links = [np.frombuffer(x, np.int32).reshape(len(self.nodes), -1).astype(np.int64) for x in row["links"]]
        self.graph = Graph(self.unit.astype(np.float32), links, row["entry"])


def planted(x: np.ndarray, cosine: float) -> np.ndarray:
    """Up to PLANTED unit vectors at ``cosine`` from rows of ``x`` (unit vectors), each in a direction of its own."""
    rows = x[np.unique(np.linspace(0, len(x) - 1, min(PLANTED, len(x))).astype(int))]
    away = np.random.default_rng(13).normal(size=rows.shape)
    away -= (away * rows).sum(axis=1, keepdims=True) * rows
    length = np.sqrt((away * away).sum(axis=1, keepdims=True))
    away /= np.maximum(length, 1e-12)  # one dimension has no other direction
    return unit(cosine * rows + np.sqrt(max(0.0, 1 - cosine * cosine)) * away)


def linked(queries: Shard, shard: Shard, cosine: float, recall: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Verified (query, node) pairs, after widening the search until the audits pass.

    One audit takes some of the queries, without what each finds of itself; the other takes planted
    vectors, which have links whether or not the queries have any. Both must reach ``recall``.
    """
    n = len(queries.nodes)
    least = cosine - ROUNDING
    audit = np.arange(0, n, max(1, min(AUDIT_EVERY, n // 16)))
    trials = [(queries.unit[audit], audit if queries is shard else np.full(len(audit), -1)), (made := planted(shard.unit, cosine), np.full(len(made), -1))]
    width = len(shard.nodes)
    exact: list[np.ndarray] = []
    margin = MARGIN

    def passes(x: np.ndarray, own: np.ndarray, wanted: np.ndarray) -> bool:
        row, node = shard.graph.within(x, least, beam, margin)
        other = node != own[row]
        return len(np.intersect1d(row[other] * width + node[other], wanted)) >= recall * len(wanted)

    while True:
        if beam * REACH >= width:  # a wider search would look at as many vectors: compare everything
            found = [np.nonzero(queries.unit[a : a + QUERY_BATCH] @ shard.unit.T >= least) for a in range(0, n, QUERY_BATCH)]
            break
        if not exact:
            for x, own in trials:
                row, node = np.nonzero(x @ shard.unit.T >= least)
                exact.append((row * width + node)[node != own[row]])
        if all(passes(x, own, wanted) for (x, own), wanted in zip(trials, exact, strict=True)):
            found = [shard.graph.within(queries.unit[a : a + QUERY_BATCH], least, beam, margin) for a in range(0, n, QUERY_BATCH)]
            break
        beam, margin = beam * 2, margin * 2
    row = np.concatenate([r + a for (r, _), a in zip(found, range(0, n, QUERY_BATCH), strict=True)]) if found else np.empty(0, int)
    node = np.concatenate([c for _, c in found]) if found else np.empty(0, int)
    row, node = np.divmod(np.unique(row * len(shard.nodes) + node), max(len(shard.nodes), 1))
    sure = np.zeros(len(row), dtype=bool)
    for a in range(0, len(row), 1 << 16):
        x, y = queries.raw[row[a : a + (1 << 16)]], shard.raw[node[a : a + (1 << 16)]]
        cos = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
        sure[a : a + (1 << 16)] = cos >= cosine
    return row[sure], node[sure]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component under the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


OUT = pa.schema([("node", pa.int64()), ("n_links", pa.int64()), ("root", pa.int64())])


def _search(cosine: float, recall: float):
    """Rows of two shards (p_..., q_...) to (node, n_links, root) of their linked vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p = Shard({k[2:]: v for k, v in row.items() if k.startswith("p_")})
                same = row["p_shard"] == row["q_shard"]
                q = p if same else Shard({k[2:]: v for k, v in row.items() if k.startswith("q_")})
                a, b = linked(q, p, cosine, recall)
                if same:  # both directions of a link are one
                    pair = np.unique(np.minimum(a, b) * len(p.nodes) + np.maximum(a, b))
                    a, b = np.divmod(pair, len(p.nodes))
                    a, b = a[a != b], b[a != b]
                shift = 0 if same else len(q.nodes)
                nodes = q.nodes if same else np.concatenate([q.nodes, p.nodes])
                b = b + shift
                copies = q.copies if same else np.concatenate([q.copies, p.copies])
                n = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
                root = local_roots(len(nodes), a, b)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[some]), pa.array(n[some].astype(np.int64)), pa.array(nodes[root[some]])], schema=OUT
                )

    return run


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    spark = ready(vectors.sparkSession)
    cuts = Cuts(spark, "hnsw")
    v = F.col("embedding").cast("array<double>")
    limit = F.lit(1e150)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & v.isNotNull() & fine, F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable, F.col("label").cast("int")).alias("label"),
        F.when(usable, v).alias("v"),
    )
    nameless = F.lit(NAMELESS) + F.shiftrightunsigned(F.xxhash64("label", "v"), 3)
    classes = cuts.cut(
        rows.where("v is not null")
        .groupBy("label", "v")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .select("label", "v", F.size("v").alias("dim"), F.coalesce("least", nameless).alias("node"), "copies")
    )
    per = classes.groupBy(F.col("label").alias("l"), F.col("dim").alias("d")).agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    per = cuts.cut(per)
    n_shards = per.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]
    shard = F.pmod(F.xxhash64("node", "v"), F.col("shards")).cast("int")
    dealt = classes.join(per, (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d"))).withColumn("shard", shard)
    dealt = dealt.select("label", "dim", "shard", "node", "copies", "v").repartition(2 * int(n_shards) + 1, "label", "dim", "shard")
    graphs = cuts.cut(dealt.groupBy("label", "dim", "shard").applyInPandas(_build, GRAPH))

    def side(name: str, columns: list[str]) -> DataFrame:
        return graphs.select(*[F.col(c).alias(f"{name}_{c}") for c in columns])

    at = ["label", "dim", "shard"]
    p, q = side("x", at), side("y", at)
    kin = (p["x_label"] == q["y_label"]) & (p["x_dim"] == q["y_dim"]) & (p["x_shard"] <= q["y_shard"])
    pairs = int(per.agg(F.coalesce(F.sum(F.col("shards") * (F.col("shards") + 1) / 2), F.lit(0))).first()[0])
    # Shard ids are paired first, then each pair fetches its two graphs by shard.
    both = p.join(q, kin)
    for ids, name in (("x", "p"), ("y", "q")):
        graph = side(name, graphs.columns)
        same = [F.col(f"{ids}_{c}") == F.col(f"{name}_{c}") for c in at]
        both = both.join(graph, same)
    both = both.drop(*[f"{ids}_{c}" for ids in "xy" for c in at]).repartition(pairs + 1)
    found = cuts.cut(both.mapInArrow(_search(cosine, recall), "node long, n_links long, root long"))
    links = found.groupBy(F.col("node").alias("f")).agg(F.sum("n_links").alias("n"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), cuts).withColumnRenamed("node", "g")
    classes = classes.join(links, F.col("node") == F.col("f"), "left").join(parts, F.col("node") == F.col("g"), "left")
    classes = classes.select(
        F.col("label").alias("l"),
        F.col("v").alias("w"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("c"),
    )
    out = rows.join(classes, (rows["label"] == classes["l"]) & (rows["v"] == classes["w"]), "left")
    component = F.when(F.col("c").isNull(), F.col("vec_id")).when(F.col("c") < NAMELESS, F.col("c"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
