"""What each filter of a chain removes, in every order the filters can stand in.

Filters are judged for each document on its own, whatever comes before; a document's failures are a
mask of bits, and only counts of masks go on. Per part a count-weighted decision diagram is built over
the masks: a level per filter, a node's two children hold the documents that pass and fail it, equal
subtrees are one node, and a node weighs its documents. Orders follow each other by swaps of two
adjacent filters, and a swap rewrites the two levels concerned. In each order the path on which all
filters pass gives the steps: what the failing child of a node weighs is removed there.

A document fails the last filter if a smaller doc_id has its text, anywhere in the table. Texts are
compared by 128-bit fingerprints; the smallest id of a fingerprint is found by partial aggregates and
looked up by (fingerprint, id), so copies of one text stay spread by their ids.

Defined results: a null text is empty; a null part is the part ''. A null doc_id is smaller than none
and has none smaller, and finds no labels; rows that repeat id, text and part count each. Several
labels of one id make it good or toxic if one of them does. A text may be of any length. An empty table
gives no rows. Extra columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hybridflow.llm.common import Cuts, ready
from hybridflow.llm.mixing import WORD

LETTERS = "ABCDE"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STEPS = (
    "part STRING, filter_order STRING, step INT, kept BIGINT, removed BIGINT, redundant BIGINT, "
    "unique_fails BIGINT, good_lost BIGINT, toxic_lost BIGINT, shapley BIGINT"
)


def text_filters(text: Column) -> list[Column]:
    """Whether a text fails: too short, repetitive, capitals, symbols. ``words`` are its words."""
    words = F.col("words")
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def failure_masks(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Documents by part and failures: ``part, mask, n, good, toxic``; bit i of ``mask`` is filter i."""
    spark = ready(docs.sparkSession)
    cuts = Cuts(spark, "masks")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), text.alias("text")
    ).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    mask = F.lit(0)
    for bit, fails in enumerate(text_filters(F.col("text"))):
        mask = mask + F.when(fails, 1 << bit).otherwise(0)
    judged = rows.select("doc_id", "part", F.md5("text").alias("print"), mask.cast("int").alias("mask"))
    judged = cuts.cut(judged.groupBy(*judged.columns).agg(F.count(F.lit(1)).alias("n")))

    known = judged.where(F.col("doc_id").isNotNull())
    later = 1 << len(text_filters(F.col("text")))
    smallest = known.groupBy("print").agg(F.min("doc_id").alias("doc_id"))
    first = smallest.withColumn("first", F.lit(True))
    known = known.join(first, ["print", "doc_id"], "left")
    known = known.withColumn("mask", F.col("mask") + F.when(F.col("first"), 0).otherwise(later)).drop("first")
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    told = known.join(told, "doc_id", "left")
    nameless = judged.where(F.col("doc_id").isNull()).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    both = told.select("part", "mask", "n", "good", "toxic").unionByName(nameless.select("part", "mask", "n", "good", "toxic"))
    sums = [F.sum("n").alias("n"), *[F.coalesce(F.sum(F.col(c) * F.col("n")), F.lit(0)).alias(c) for c in ("good", "toxic")]]
    return both.groupBy("part", "mask").agg(*sums)


class Diagram:
    """Count-weighted decision diagram over masks, every level present and equal subtrees shared.

    A node is ``(passing child, failing child)`` by number, a leaf the weights of one mask.
    ``order[level]`` is the filter tested there.
    """

    def __init__(self, width: int, weights: dict[int, tuple[int, ...]], n_weights: int = 3):
        self.order = list(range(width))
        self._numbers: dict[tuple, int] = {}
        self._nodes: list[tuple] = []
        self._weights: list[tuple[int, ...]] = []
        none = (0,) * n_weights

        def built(level: int, mask: int) -> int:
            if level == width:
                return self._leaf(weights.get(mask, none))
            return self._node(built(level + 1, mask), built(level + 1, mask | 1 << level))

        self.root = built(0, 0)

    def _leaf(self, weights: tuple[int, ...]) -> int:
        return self._number(("leaf", *weights), weights)

    def _node(self, passing: int, failing: int) -> int:
        known = self._numbers.get((passing, failing))
        if known is not None:
            return known
        pairs = zip(self._weights[passing], self._weights[failing], strict=True)
        return self._number((passing, failing), tuple(a + b for a, b in pairs))

    def _number(self, node: tuple, weights: tuple[int, ...]) -> int:
        if node not in self._numbers:
            self._numbers[node] = len(self._nodes)
            self._nodes.append(node)
            self._weights.append(weights)
        return self._numbers[node]

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next; levels above keep their form, those below stay."""
        done: dict[int, int] = {}

        def rewritten(node: int, at: int) -> int:
            if node not in done:
                passing, failing = self._nodes[node]
                if at < level:
                    done[node] = self._node(rewritten(passing, at + 1), rewritten(failing, at + 1))
                else:
                    (pp, pf), (fp, ff) = self._nodes[passing], self._nodes[failing]
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = rewritten(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the path on which all filters pass: the filter, weights kept after it and removed by it."""
        node = self.root
        for filter_no in self.order:
            node, failing = self._nodes[node]
            yield filter_no, self._weights[node], self._weights[failing]


def swaps(width: int) -> Iterator[int]:
    """Levels to swap with the next, one after another, so that each order but the first comes up once."""
    if width > 1:
        inner, down = swaps(width - 1), True
        while True:
            yield from range(width - 2, -1, -1) if down else range(width - 1)
            step = next(inner, None)
            if step is None:
                return
            yield step + 1 if down else step
            down = not down


def part_steps(part: str, weights: dict[int, tuple[int, int, int]], letters: str = LETTERS) -> pd.DataFrame:
    """All orders' steps of one part, from its masks' (documents, good, toxic)."""
    width = len(letters)
    fails = [sum(w[0] for m, w in weights.items() if m >> i & 1) for i in range(width)]
    alone = [weights.get(1 << i, (0, 0, 0))[0] for i in range(width)]
    diagram = Diagram(width, weights)
    rows, removed_at_all = [], [0] * width

    def walk():
        order = "".join(letters[i] for i in diagram.order)
        for step, (i, kept, removed) in enumerate(diagram.steps(), 1):
            removed_at_all[i] += removed[0]
            rows.append((part, order, step, kept[0], removed[0], fails[i] - removed[0], alone[i], removed[1], removed[2], i))

    walk()
    for level in swaps(width):
        diagram.swap(level)
        walk()
    columns = [f.split()[0] for f in STEPS.split(", ")]
    return pd.DataFrame([(*r[:-1], removed_at_all[r[-1]]) for r in rows], columns=columns)


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row per part, order of the filters and step; ``masks`` as from :func:`failure_masks`."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        weights = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in rows.itertuples(index=False)}
        return part_steps(rows["part"].iloc[0], weights, letters)

    return masks.groupBy("part").applyInPandas(run, STEPS)


def orders(letters: str = LETTERS) -> list[str]:
    return sorted("".join(p) for p in permutations(letters))
