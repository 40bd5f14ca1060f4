"""Running folds: one output row per input row, with its key's totals so far."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    LongType,
    NumericType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from hybridflow.operators.keyed import ROWS_PER_TASK, hot_keys, rows_per_key, with_key_slots

# Rows looked at per slice to find cut points.
SAMPLED_PER_SLICE = 1_000


@dataclass(frozen=True)
class Fold:
    """How rows accumulate: ``count``, ``sum``, ``min``, ``max`` or ``last`` of a column.

    Each kind can be merged, so totals of parts give the total of the whole. ``last`` is the value
    of the latest row that has one, by the columns ``order`` (null comes first; of rows that tie the
    highest value counts). Its total is a struct of that row's order and ``value``, so totals of slices,
    micro-batches and sides merge in any sequence; :func:`with_values` shows the value alone.
    """

    name: str
    kind: str
    column: str | None = None
    order: tuple[str, ...] = ()

    def over_rows(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1))
        if self.kind == "last":
            at = [F.col(c).alias(f"at{i}") for i, c in enumerate(self.order)]
            return F.max(F.when(F.col(self.column).isNotNull(), F.struct(*at, F.col(self.column).alias("value"))))
        return getattr(F, self.kind)(self.column)

    def over_totals(self, total: str) -> Column:
        if self.kind in ("count", "last"):
            return F.sum(total) if self.kind == "count" else F.max(total)
        return getattr(F, self.kind)(total)

    def result_type(self, schema: StructType) -> DataType:
        """Type of the fold over rows of this schema."""
        if self.kind == "count":
            return LongType()
        kind = schema[self.column].dataType
        if self.kind == "last":
            at = [StructField(f"at{i}", schema[c].dataType) for i, c in enumerate(self.order)]
            return StructType([*at, StructField("value", kind)])
        if self.kind == "sum" and isinstance(kind, DecimalType):  # as Spark's own sum
            return DecimalType(min(38, kind.precision + 10), kind.scale)
        if self.kind == "sum" and isinstance(kind, IntegralType):
            return LongType()
        return DoubleType() if self.kind == "sum" and isinstance(kind, FloatType) else kind

    def merged(self, a: Column, b: Column) -> Column:
        """Of two totals either may be null, meaning no rows."""
        if self.kind in ("count", "sum"):
            return F.coalesce(a + b, a, b)
        return F.least(a, b) if self.kind == "min" else F.greatest(a, b)


def with_values(df: DataFrame, folds: list[Fold]) -> DataFrame:
    """Totals as they are shown: of ``last`` folds the value without its order."""
    values = {f.name: F.col(f.name)["value"] for f in folds if f.kind == "last"}
    return df.withColumns(values) if values else df


def fold_totals(rows: DataFrame, key: list[str], folds: list[Fold]) -> DataFrame:
    """Final totals per key."""
    return rows.groupBy(*key).agg(*[f.over_rows().alias(f.name) for f in folds])


def merge_totals(old: DataFrame, new: DataFrame, key: list[str], folds: list[Fold]) -> DataFrame:
    """Totals of two sets of rows as totals of both; other columns of ``old`` are kept."""
    old, slots = with_key_slots(old, key)
    new, _ = with_key_slots(new, key)
    names = {f.name: f for f in folds}
    new = new.select(*slots, *[F.col(c).alias(f"_new_{c}") for c in [*key, *names]])
    columns = []
    for name in old.drop(*slots).columns:
        if name in key:
            columns.append(F.coalesce(F.col(name), F.col(f"_new_{name}")).alias(name))
        elif name in names:
            merged = names[name].merged(F.col(name), F.col(f"_new_{name}"))
            columns.append(merged.alias(name))
        else:
            columns.append(F.col(name))
    return old.join(new, slots, "full_outer").select(*columns)


def rolling_fold(
    rows: DataFrame,
    key: list[str],
    order: list[str],
    folds: list[Fold],
    side: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_TASK,
    counts: DataFrame | None = None,
    side_repeats: bool = False,
) -> DataFrame:
    """Each row with the folds of its key over all rows up to and including it.

    ``order`` is a time or number, followed by a number that breaks ties. ``side`` has
    one row per key: columns named like a fold start that fold, all others are attached
    to the key's rows (null where the key is missing).

    Keys that fit into a task go through one shuffle on the key, which window and join
    share. If some key does not fit, its rows are cut into consecutive slices of the
    order; each slice is folded by its own task and starts from the totals of the slices
    before it, so no task ever sees all rows of a hot key.
    """
    starts = [f for f in folds if side is not None and f.name in side.columns]
    extras = [] if side is None else [
        c for c in side.columns if c not in key and c not in {f.name for f in folds}
    ]
    for name in order:
        _as_number(rows, name)  # one that cannot be cut into slices is an error at every size
    counts = rows_per_key(rows, key) if counts is None else counts
    hot = hot_keys(counts.select(*key, "n_rows"), rows_per_slice)
    keyed, slots = with_key_slots(rows, key)
    if side is not None:
        side, _ = with_key_slots(side, key)
        side = side.select(*slots, *extras, *[F.col(f.name).alias(f"_start_{f.name}") for f in starts])
        given = [c for c in side.columns if c not in slots]
        if side_repeats and given:
            side = side.groupBy(*slots).agg(F.max(F.struct(*given)).alias("_r")).select(*slots, "_r.*")
        elif side_repeats:
            side = side.distinct()

    if hot is not None:
        keyed, side, starts = _sliced(keyed, side, slots, key, order, folds, starts, hot, rows_per_slice)
        slots = [*slots, "_slice"]

    window = (
        Window.partitionBy(*slots)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = keyed.withColumns({f.name: f.over_rows().over(window) for f in folds})
    if side is not None:
        out = out.join(side, slots, "left")
        out = out.withColumns(
            {f.name: f.merged(F.col(f.name), F.col(f"_start_{f.name}")) for f in starts}
        )
    return out.select(*rows.columns, *[f.name for f in folds], *extras)


def _sliced(keyed, side, slots, key, order, folds, starts, hot, rows_per_slice):
    """Cut the rows of hot keys into slices and give every slice its starting totals."""
    hot, n_hot_rows, few = hot
    hot, _ = with_key_slots(hot, key)
    hot = hot.select(*slots, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot) if few else hot
    keyed = keyed.join(hot, slots, "left")
    wanted = math.ceil(n_hot_rows / rows_per_slice)
    share = min(1.0, SAMPLED_PER_SLICE * wanted / n_hot_rows)
    keyed = _with_slices(keyed, order, wanted, share).drop("_hot")

    # Slice -1 holds the whole of a key that is not hot.
    totals = fold_totals(keyed.where(F.col("_slice") >= 0), [*slots, "_slice"], folds)
    before = Window.partitionBy(*slots).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = totals.select(
        *slots, "_slice", *[f.over_totals(f.name).over(before).alias(f"_before_{f.name}") for f in folds]
    )
    begun = {f.name for f in starts}
    if side is None:
        starting = slices.select(
            *slots, "_slice", *[F.col(f"_before_{f.name}").alias(f"_start_{f.name}") for f in folds]
        )
        return keyed, starting, folds

    extras = [c for c in side.columns if c not in slots and not c.startswith("_start_")]
    hot_side = slices.join(side, slots, "left").select(
        *slots,
        "_slice",
        *extras,
        *[
            (
                f.merged(F.col(f"_before_{f.name}"), F.col(f"_start_{f.name}"))
                if f.name in begun
                else F.col(f"_before_{f.name}")
            ).alias(f"_start_{f.name}")
            for f in folds
        ],
    )
    cold_side = side.join(hot, slots, "left_anti").withColumn(
        "_slice", F.lit(-1).cast("bigint")
    )
    return keyed, hot_side.unionByName(cold_side, allowMissingColumns=True), folds


def _with_slices(rows: DataFrame, order: list[str], wanted: int, share: float = 1.0) -> DataFrame:
    """Number the slices of hot rows so that slice numbers never fall along the order.

    Cut points are quantiles of the first order column. A value that fills more than a
    slice by itself gets an interval of its own, cut further by the second column. The
    cut points decide only how even the slices are, any cut points give right results;
    so they are taken from a ``share`` of the rows.
    """
    hot = F.coalesce(F.col("_hot"), F.lit(False))
    rows = rows.withColumn("_first", _as_number(rows, order[0]))
    drawn = rows.where(F.rand(0) < share) if share < 1.0 else rows
    cuts = _quantiles(drawn.where(hot), "_first", wanted)
    crowded = sorted(v for v, n in Counter(cuts).items() if n > 1 and _is_exact(rows, order[0], v))
    edges = sorted({*cuts, *(math.nextafter(v, math.inf) for v in crowded)})
    number, inner_size = _bucket(rows, "_first", edges, "_outer"), 1
    # Nulls sort first: slices below those of any number, cut by the second column like a crowded value.
    number = number.withColumn("_outer", F.when(F.col("_first").isNull(), 0.0).otherwise(F.col("_outer") + 1))
    if len(order) > 1:
        number = number.withColumn("_second", _as_number(rows, order[1]))
        is_crowded = hot & (F.col("_first").isNull() | F.col("_first").isin(crowded))
        drawn = drawn.withColumn("_second", _as_number(rows, order[1])).where(is_crowded)
        inner_edges = sorted(set(_quantiles(drawn, "_second", wanted)))
        inner_size = len(inner_edges) + 2
        number = _bucket(number, "_second", inner_edges, "_inner")
        inner = F.when(F.col("_second").isNull(), 0.0).otherwise(F.col("_inner") + 1)
        number = number.withColumn("_inner", F.when(is_crowded, inner).otherwise(0.0)).drop("_second")
    else:
        number = number.withColumn("_inner", F.lit(0.0))
    slice_no = F.col("_outer").cast("bigint") * inner_size + F.col("_inner").cast("bigint")
    return number.withColumn("_slice", F.when(hot, slice_no).otherwise(F.lit(-1))).drop(
        "_first", "_outer", "_inner"
    )


def _as_number(rows: DataFrame, name: str) -> Column:
    """A number that never falls along the order, or null where the value is."""
    kind = rows.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, NumericType):
        raise TypeError(f"rows are ordered by times and numbers; {name} is {kind.simpleString()}")
    return c.cast("double")


def _is_exact(rows: DataFrame, name: str, number: float) -> bool:
    """Whether only one value of the column has this number, so that ties are true ties."""
    kind = rows.schema[name].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        return True
    return not isinstance(kind, DecimalType) and abs(number) < 2**53


def _quantiles(rows: DataFrame, name: str, n: int) -> list[float]:
    shares = [i / n for i in range(1, n)] or [0.5]
    found = rows.agg(F.percentile_approx(name, shares, max(10_000, 20 * n))).first()[0]
    return [v for v in found or [] if math.isfinite(v)]


def _bucket(rows: DataFrame, name: str, edges: list[float], alias: str) -> DataFrame:
    """Number of edges at or below the value, looked up by binary search."""
    if not edges:
        return rows.withColumn(alias, F.lit(0.0))
    splits = [-math.inf, *edges, math.inf]
    return Bucketizer(
        splits=splits, inputCol=name, outputCol=alias, handleInvalid="keep"
    ).transform(rows)
