"""Main text of HTML pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

Every page becomes a tree of text-carrying nodes, each described by its own and its subtree's
amounts and densities of text, links and sentence ends, tokens of its tag and attributes and of those
around it, depth, place and siblings. Boosted trees, trained here by Spark ML on made-up pages
whose main text is known, give each node the chance that its subtree holds main text. Decoding
picks the best labelling of the tree in which nothing below a rejected node is kept: a sum over
nodes, from the leaves up, so ancestor and descendant never contradict one another.

Pages are handled one at a time where they are read; what travels is the trees.

Defined results: a null or empty page, or one without main text, gives an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.llm.common import Cuts, ready
from hybridflow.llm.dom import Node, chosen_text, describe, parse
from hybridflow.llm.template_pages import page

TRAINING_PAGES = 2000
TREES = 20
DEPTH = 5


def training_nodes(spark: SparkSession, pages: int, seed: int = 1) -> DataFrame:
    """``label, features, page`` of every node of the made-up pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, rows, ids = [], [], []
            for i in batch.column(0).to_pylist():
                nodes, _ = parse(page(seed * 1_000_003 + i))
                rows += describe(nodes)
                labels += [float(x.truth) for x in nodes]
                ids += [i] * len(nodes)
            yield pa.RecordBatch.from_arrays([pa.array(labels), pa.array(rows, pa.list_(pa.float64())), pa.array(ids)], ["label", "values", "page"])

    nodes = spark.range(0, pages, 1, 8).mapInArrow(run, "label double, values array<double>, page long")
    return nodes.select("label", array_to_vector("values").alias("features"), "page")


def _trees(model: GBTClassificationModel) -> list[tuple[float, np.ndarray]]:
    """(weight, rows of feature, threshold, left, right, value) of every tree, read node by node."""
    out = []
    for weight, tree in zip(model.treeWeights, model.trees, strict=True):
        rows: list[list[float]] = []

        def grow(node, rows=rows) -> int:
            at = len(rows)
            rows.append([-1, 0.0, 0, 0, node.prediction()])
            if node.subtreeDepth() > 0:
                split = node.split()
                rows[at][:2] = [split.featureIndex(), split.threshold()]
                rows[at][2] = grow(node.leftChild())
                rows[at][3] = grow(node.rightChild())
            return at

        grow(tree._java_obj.rootNode())
        out.append((float(weight), np.array(rows, dtype=float)))
    return out


class NodeModel:
    """Boosted trees as arrays; evaluates all nodes of a page at once."""

    def __init__(self, trees: list[tuple[float, np.ndarray]]):
        self.trees = trees

    def chance(self, rows: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(rows))
        each = np.arange(len(rows))
        for weight, nodes in self.trees:
            at = np.zeros(len(rows), dtype=int)
            while True:
                feature = nodes[at, 0].astype(int)
                inner = feature >= 0
                if not inner.any():
                    break
                left = rows[each, np.maximum(feature, 0)] <= nodes[at, 1]
                at = np.where(inner, np.where(left, nodes[at, 2], nodes[at, 3]), at).astype(int)
            margin += weight * nodes[at, 4]
        return 1 / (1 + np.exp(-2 * margin))


def fit(spark: SparkSession, pages: int = TRAINING_PAGES, trees: int = TREES, depth: int = DEPTH) -> NodeModel:
    """Train the node classifier; the training rows are cut once, and no page of the corpus is used."""
    cuts = Cuts(ready(spark), "html-nodes")
    rows = cuts.cut(training_nodes(spark, pages))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, maxBins=64).fit(rows)
    cuts.drop(rows)
    return NodeModel(_trees(model))


def decode(nodes: list[Node], chance: np.ndarray) -> list[bool]:
    """The likeliest labelling in which nothing below a rejected node is kept."""
    p = np.clip(chance, 1e-4, 1 - 1e-4)
    keep_gain, drop_gain = np.log(p), np.log(1 - p)
    keep, below = keep_gain.copy(), drop_gain.copy()  # best of the subtree if kept, if rejected
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent.order
        keep[up] += max(keep[i], below[i])
        below[up] += below[i]
    out = [False] * len(nodes)
    for i, node in enumerate(nodes):
        out[i] = keep[i] > below[i] and (i == 0 or out[node.parent.order])
    return out


def main_texts(pages: list[str | None], model: NodeModel) -> list[str]:
    """Main text of each page; the nodes of all are put through the trees together."""
    read = [parse(html) if html else ([], []) for html in pages]
    rows = [row for nodes, _ in read for row in describe(nodes)]
    chance = model.chance(np.array(rows)) if rows else np.empty(0)
    out, at = [], 0
    for nodes, pieces in read:
        own = chance[at : at + len(nodes)]
        at += len(nodes)
        out.append(chosen_text(pieces, decode(nodes, own)) if nodes else "")
    return out


def extract(pages: DataFrame, model: NodeModel) -> DataFrame:
    """Per row: ``page_id, url, text``."""
    ready(pages.sparkSession)
    trees = model.trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = NodeModel(trees)
        for batch in batches:
            texts = main_texts(batch.column(2).to_pylist(), own)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
