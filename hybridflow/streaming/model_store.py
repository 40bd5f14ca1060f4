"""Models as rows of a versioned table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "model_key STRING, version BIGINT, weights ARRAY<DOUBLE>, error_rate DOUBLE"


class ModelStore:
    """Push and pull models by key. A version is written whole and never changed in place."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def push(self, key: str, version: int, weights: list[float], error_rate: float | None) -> None:
        """Write a version; pushing the same one again replaces it."""
        row = [(key, version, [float(w) for w in weights], error_rate)]
        frame = self.spark.createDataFrame(row, SCHEMA).coalesce(1)
        out = frame.write.mode("overwrite").partitionBy("model_key", "version")  # which escapes the key
        out.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def history(self) -> DataFrame:
        """Every pushed version of every model."""
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def latest(self, up_to: int | None = None) -> DataFrame:
        """The newest version of each model, optionally as it was at version ``up_to``."""
        return latest_models(self.history(), up_to)

    def pull(self, key: str, up_to: int | None = None) -> tuple[int, list[float], float | None] | None:
        """Newest version, weights and error rate of a model, or None before the first push."""
        row = self.latest(up_to).where(F.col("model_key") == key).first()
        return None if row is None else (row["version"], list(row["weights"]), row["error_rate"])


def latest_models(history: DataFrame, up_to: int | None = None) -> DataFrame:
    if up_to is not None:
        history = history.where(F.col("version") <= up_to)
    newest = F.max_by(F.struct("weights", "error_rate"), "version").alias("m")
    return history.groupBy("model_key").agg(F.max("version").alias("version"), newest).select(
        "model_key", "version", "m.*"
    )
