"""From documents to a training mix: toxic documents go, repeated lines go, one document of each
near-duplicate group stays, benchmark passages go, and sources are mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hybridflow.llm import decontaminate, line_dedup, minhash, mixing, toxicity
from hybridflow.llm.common import Cuts, ready


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a scorer learnt from the labelled ones among them."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeated three-line windows cover."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What each document gives to the mix, in words, and how often it is repeated whole."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", toxic),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
]

#: No SQL expresses the trained scorer; tests hold the pipeline against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read by the next."""
    ready(spark)
    cuts = Cuts(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = cuts.cut(stage(spark, docs, sf_dir))
        if before is not None:
            cuts.drop(before)
        before = docs
    return docs
