"""Online logistic regression that goes back to history when its error is high."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.functions.sampling import sample_rows
from hybridflow.operators.learn import SAMPLING_RATE, THRESHOLD, gradient, stepped
from hybridflow.streaming.model_store import ModelStore

TRACE_SCHEMA = "batch_id BIGINT, error_rate DOUBLE, action STRING, pushed BOOLEAN, n_invalid BIGINT"


@dataclass(frozen=True)
class Settings:
    """``rate`` is the step size; ``row_id`` makes the history sample repeatable."""

    n_features: int
    rate: float
    threshold: float = THRESHOLD
    sampling_rate: float = SAMPLING_RATE
    metric: str = "log_loss"
    model_key: str = "hybrid-logistic-regression"
    row_id: str | None = None
    seed: int = 0


class HybridTrainer:
    """``foreachBatch`` function: one training step per micro-batch of ``label, features``.

    Each micro-batch is scored with the model as pulled, and one gradient step is taken on
    it. If the error is above the threshold, a second step follows on a sample of history
    together with rows buffered so far. While history is not complete (``ready``), the
    micro-batch is buffered instead, and as long as the buffer holds rows no model is
    pushed. Without ``ready`` history is complete from the start.

    Rows that cannot teach (no finite label, missing or other features) are set aside; the
    trace has their number, those of the micro-batch itself.

    All that is remembered lies in tables below ``path``, by batch number: a micro-batch
    that is run again sees what it saw the first time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        history: Callable[[], DataFrame],
        settings: Settings,
        ready: Callable[[], bool] | None = None,
    ):
        self.spark = spark
        self.path = path
        self.history = history
        self.settings = settings
        self.ready = ready
        self.models = ModelStore(spark, f"{path}/models")
        self._next: tuple[int, list[float], list[int]] | None = None

    def start_from(self, weights: list[float] | None = None) -> None:
        """Push version 0, zeros if no weights are given."""
        first = weights or [0.0] * self.settings.n_features
        self._next = None
        self.models.push(self.settings.model_key, 0, first, None)

    def trace(self) -> DataFrame:
        """What happened in each micro-batch."""
        return self.spark.read.schema(TRACE_SCHEMA).parquet(f"{self.path}/trace")

    def quality(self) -> DataFrame:
        """The error rates that went out, one per push."""
        return self.trace().where("pushed").select("batch_id", "error_rate")

    def _before(self, batch_id: int) -> tuple[list[float], list[int]]:
        """Weights and buffer as a micro-batch finds them: what the one before it left, in this
        process or else in the tables."""
        if self._next is not None and self._next[0] == batch_id:
            return self._next[1], list(self._next[2])
        _, weights, _ = self.models.pull(self.settings.model_key, up_to=batch_id)
        return weights, self._buffered(batch_id) if self.ready else []

    def _buffered(self, batch_id: int) -> list[int]:
        """Numbers of the micro-batches in the buffer. The trace has one short row per batch."""
        if batch_id == 0:
            return []
        seen = self.trace().where(F.col("batch_id") < batch_id)
        drained = seen.where(F.col("action") == "retrain").agg(F.max("batch_id")).first()[0]
        held = seen.where(F.col("action") == "buffer")
        if drained is not None:
            held = held.where(F.col("batch_id") > drained)
        return [r[0] for r in held.select("batch_id").collect()]

    def _record(self, batch_id: int, error: float | None, action: str, pushed: bool, bad: int) -> None:
        row = self.spark.createDataFrame([(batch_id, error, action, pushed, bad)], TRACE_SCHEMA)
        folder = f"{self.path}/trace/batch_id={batch_id}"
        row.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(folder)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        s = self.settings
        rows = rows.select("label", "features")
        weights, held = self._before(batch_id)
        new = gradient(rows, weights, s.metric)
        if new.n == 0:
            self._record(batch_id, None, "empty", False, new.n_invalid)
            self._next = (batch_id + 1, weights, held)
            return
        moved = stepped(weights, new, s.rate)
        action = "step"
        if new.error > s.threshold:
            if self.ready is None or self.ready():
                action = "retrain"
                moved = stepped(moved, gradient(self._mini_batch(held), moved, s.metric), s.rate)
                held = []
            else:
                action = "buffer"
                rows.write.mode("overwrite").parquet(f"{self.path}/buffer/batch_id={batch_id}")
                held = [*held, batch_id]
        if not held:
            self.models.push(s.model_key, batch_id + 1, moved, new.error)
        self._record(batch_id, new.error, action, not held, new.n_invalid)
        self._next = (batch_id + 1, weights if held else moved, held)

    def _mini_batch(self, held: list[int]) -> DataFrame:
        s = self.settings
        past = sample_rows(self.history(), s.sampling_rate, s.seed, s.row_id)
        past = past.select("label", "features")
        if not held:
            return past
        folders = [f"{self.path}/buffer/batch_id={b}" for b in held]
        return past.unionByName(self.spark.read.schema(past.schema).parquet(*folders))
