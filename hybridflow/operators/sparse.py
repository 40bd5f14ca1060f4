"""Logistic regression over sparse rows, for models of any width. Weights are a table ``j, w``.

Rows are packed once, where they are read, into tiles: the entries of a group of rows that lie in one
block of features. A step then moves small vectors, never entries: weights go to the tiles by feature
block, each tile adds up its rows' partial scores, the partial scores of a group give the residuals of
its rows, and these go back to the group's tiles, each of which gives its part of the gradient. Parts are
summed per feature. Neither the driver nor a plan holds the weights, and no task all of them.

A feature that most rows have is in a tile once per group and summed there, and the tiles of one block
are dealt over ``salts`` copies of its weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.session import new_path

GROUP_ROWS = 4_096
BLOCK_FEATURES = 1 << 16
#: Entries held before a group is closed early, so that long rows don't make a large group.
GROUP_ENTRIES = 4_000_000
SALTS = 16

LARGE_ROWS = {
    "spark.sql.parquet.enableNestedColumnVectorizedReader": "false",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

#: The tile that carries a group's labels.
LABELS = -1
TILE = "grp BIGINT, block BIGINT, rows ARRAY<INT>, features ARRAY<INT>, x ARRAY<DOUBLE>"


def usable(label: Column, indices: Column, values: Column) -> Column:
    """Whether a row can teach: a finite label, as many features as values, and all of them numbers."""

    def finite(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))

    same = F.size(indices) == F.size(values)
    known = F.forall(indices, lambda j: j.isNotNull() & (j >= 0)) & F.forall(values, lambda v: finite(v.cast("double")))
    return F.coalesce(finite(label.cast("double")) & same & known, F.lit(False))


def tiles_of(
    rows: DataFrame,
    label: str = "label",
    indices: str = "indices",
    values: str = "values",
    group_rows: int = GROUP_ROWS,
    block_features: int = BLOCK_FEATURES,
) -> DataFrame:
    """Rows as tiles, without a shuffle. Features that a row repeats add up; rows that cannot teach are left out."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        n_groups, labels, entries, held = 0, [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, group_rows):
                part = batch.slice(at, group_rows)
                while part.num_rows:
                    done = sum(len(y) for y in labels)
                    ends = part.column(1).offsets.to_numpy()
                    full = int(np.searchsorted(ends - ends[0], GROUP_ENTRIES - held))  # rows until there are enough entries
                    room = min(group_rows - done, max(full, 1))
                    taken, part = part.slice(0, room), part.slice(min(room, part.num_rows))
                    labels.append(taken.column(0).to_numpy(zero_copy_only=False))
                    lists = taken.column(1)
                    sizes = np.diff(lists.offsets.to_numpy())
                    entries.append(
                        (np.repeat(np.arange(len(sizes)) + done, sizes), lists.flatten().to_numpy(), taken.column(2).flatten().to_numpy())
                    )
                    held += len(entries[-1][0])
                    if done + taken.num_rows == group_rows or held >= GROUP_ENTRIES:
                        yield from packed(first + n_groups, labels, entries)
                        n_groups, labels, entries, held = n_groups + 1, [], [], 0
        if labels:
            yield from packed(first + n_groups, labels, entries)

    def packed(group: int, labels: list, entries: list) -> Iterator[pa.RecordBatch]:
        y = np.concatenate(labels)
        yield tile(group, LABELS, np.arange(len(y)), np.zeros(len(y), int), y)
        row, feature, x = (np.concatenate(c) for c in zip(*entries, strict=True))
        order = np.lexsort((row, feature))
        row, feature, x = row[order], feature[order], x[order]
        if len(x):  # a feature that a row repeats is one entry
            first = np.flatnonzero((np.diff(feature, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
            row, feature, x = row[first], feature[first], np.add.reduceat(x, first)
        block = feature // block_features
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1)) if len(block) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield tile(group, int(block[a]), row[a:b], feature[a:b] % block_features, x[a:b])

    def tile(group, block, rows, features, x) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([group]), pa.array([block]), pa.array([rows.astype(np.int32)], pa.list_(pa.int32())),
             pa.array([features.astype(np.int32)], pa.list_(pa.int32())), pa.array([x], pa.list_(pa.float64()))],
            ["grp", "block", "rows", "features", "x"],
        )

    y, j, x = F.col(label), F.col(indices), F.col(values)
    given = rows.where(usable(y, j, x)).select(y.cast("double"), j.cast("array<bigint>"), x.cast("array<double>"))
    return given.mapInArrow(pack, TILE)


def _list(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False) if column[i].is_valid else np.zeros(0)


def _partial_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, rows, features, x, weights of the block) to (grp, rows, score): a value per row of the tile."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows, features, x, at, w = (_list(batch.column(k), i) for k in range(1, 6))
            dense = np.zeros(1 + int(max(features.max(initial=0), at.max(initial=0))))
            dense[at.astype(int)] = w
            seen, where = np.unique(rows, return_inverse=True)
            score = np.bincount(where, dense[features] * x, len(seen))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), pa.array([seen], pa.list_(pa.int32())), pa.array([score], pa.list_(pa.float64()))], ["grp", "rows", "x"]
            )


def _residuals(parts: pa.Table) -> pa.Table:
    """A group's labels and partial scores to what is missing in each row, and the group's loss."""
    parts = parts.combine_chunks()
    is_label = np.asarray(pc.equal(parts["kind"], LABELS))
    y = parts["x"][int(np.flatnonzero(is_label)[0])].values.to_numpy()
    z = np.zeros(len(y))
    for i in np.flatnonzero(~is_label):
        z[parts["rows"][int(i)].values.to_numpy()] += parts["x"][int(i)].values.to_numpy()
    p = 1.0 / (1.0 + np.exp(-z))
    safe = np.clip(p, 1e-15, 1.0 - 1e-15)
    loss = -float(np.sum(y * np.log(safe) + (1.0 - y) * np.log1p(-safe)))
    return pa.table(
        {"grp": parts["grp"].slice(0, 1), "n": pa.array([len(y)], pa.int64()), "loss": pa.array([loss]), "r": pa.array([p - y], pa.list_(pa.float64()))}
    )


def _partial_gradients(block_features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, rows, features, x, r) to (j, g): a row per feature of the tile."""
        for batch in batches:
            for i in range(batch.num_rows):
                rows, features, x, r = (_list(batch.column(k), i) for k in range(1, 5))
                seen, where = np.unique(features, return_inverse=True)
                g = np.bincount(where, r[rows] * x, len(seen))
                first = batch.column(0)[i].as_py() * block_features
                yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64) + first), pa.array(g)], ["j", "g"])

    return run


def residuals(tiles: DataFrame, weights: DataFrame, block_features: int = BLOCK_FEATURES, salts: int = SALTS) -> DataFrame:
    """Per group of rows ``grp, n, loss`` and ``r``, predicted less given for each row."""
    at = F.struct((F.col("j") % block_features).cast("int").alias("j"), "w")
    blocks = weights.groupBy(F.floor(F.col("j") / block_features).alias("block")).agg(F.collect_list(at).alias("ws"))
    blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    placed = tiles.where(F.col("block") != LABELS).withColumn("salt", F.pmod(F.xxhash64("grp"), F.lit(salts)).cast("int"))
    joined = placed.join(blocks, ["block", "salt"], "left")
    scores = joined.select("grp", "rows", "features", "x", F.col("ws.j").alias("at"), F.col("ws.w").alias("w"))
    scores = scores.mapInArrow(_partial_scores, "grp BIGINT, rows ARRAY<INT>, x ARRAY<DOUBLE>").withColumn("kind", F.lit(0))
    labels = tiles.where(F.col("block") == LABELS).select("grp", "rows", "x", F.lit(LABELS).alias("kind"))
    return labels.unionByName(scores).groupBy("grp").applyInArrow(_residuals, "grp BIGINT, n BIGINT, loss DOUBLE, r ARRAY<DOUBLE>")


def gradient_of(tiles: DataFrame, found: DataFrame, block_features: int = BLOCK_FEATURES) -> DataFrame:
    """``j, g``: the gradient's sum over all rows, for the features that occur; ``found`` are the residuals."""
    joined = tiles.where(F.col("block") != LABELS).join(found.select("grp", "r"), "grp")
    parts = joined.select("block", "rows", "features", "x", "r").mapInArrow(_partial_gradients(block_features), "j BIGINT, g DOUBLE")
    return parts.groupBy("j").agg(F.sum("g").alias("g"))


@contextmanager
def few_at_once(spark: SparkSession) -> Iterator[None]:
    """Settings for rows of megabytes: Spark counts rows, thousands of which make a batch when it reads or goes to Python."""
    before = {name: spark.conf.get(name) for name in LARGE_ROWS}
    for name, value in LARGE_ROWS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def no_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "j BIGINT, w DOUBLE")


def train(
    rows: DataFrame,
    steps: int,
    rate: float,
    start: DataFrame | None = None,
    block_features: int = BLOCK_FEATURES,
    **columns,
) -> tuple[DataFrame, list[float]]:
    """Weights after so many full steps against the mean gradient, and the mean loss before each.

    Tiles, residuals and each step's weights are written, so a lost executor costs a step.
    """
    spark = rows.sparkSession
    path = new_path(spark, "sparse")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    with few_at_once(spark):
        tiles = written(tiles_of(rows, block_features=block_features, **columns), "tiles")
        weights, losses = no_weights(spark) if start is None else start, []
        for step in range(steps):
            found = written(residuals(tiles, weights, block_features), f"residuals-{step}")
            n, loss = found.agg(F.sum("n"), F.sum("loss")).first()
            if not n:
                return weights, losses
            losses.append(loss / n)
            moved = weights.join(gradient_of(tiles, found, block_features), "j", "full_outer")
            w = F.coalesce("w", F.lit(0.0)) - F.lit(rate / n) * F.coalesce("g", F.lit(0.0))
            weights = written(moved.select("j", w.alias("w")), f"weights-{step}")
        return weights, losses
