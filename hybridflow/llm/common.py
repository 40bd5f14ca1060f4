"""What the operators share: session settings, written cuts of the lineage, row keys."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hybridflow.session import new_path, prepare

#: Bytes of one Arrow batch on its way to Python, so that very long texts come a few at a time.
BATCH_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Settings these operators rely on.

    Shuffle files of a written step are not needed once it is written; without the clean-up
    they stay until the driver happens to collect its garbage.
    """
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


class Cuts:
    """Tables written to the shared folder between steps, so that a lost executor costs one step."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = new_path(spark, label)
        self._written = 0

    def cut(self, df: DataFrame) -> DataFrame:
        """``df``, computed once, written and read again."""
        path = f"{self.root}/{self._written}"
        self._written += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._cut_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove cuts that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(df._cut_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def keyed_text(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tag`` and ``text`` alone; extra columns of any name stay behind.

    The pair (doc_id, tag) names a row: rows that repeat both id and text are one document.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_tag(F.col("text")).alias("tag"),
        F.col("text").cast("string").alias("text"),
    )


def text_tag(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")), text.isNull())


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on the row key, where a null id equals a null id."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tag"] == b["tag"])


def record_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    """Row dicts of columns as Arrow batches of at most ``size`` rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
