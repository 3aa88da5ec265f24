"""The stages of the pipeline: quality, near-duplicates, benchmark passages, personal data, mixing.

Each stage takes the documents that the one before kept and returns them with their columns; the
last returns what the mixture takes of each document. Tables beside the documents are read from
the folder of the input. A labelled table covers some documents only; all are judged. Every stage
judges rows, whether they have an id or not, and gives an empty table for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, mixing, pii, quality, simhash_sets
from .common import forget, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers keep."""
    return quality.kept(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash_sets.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` counts the new text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in out.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mixture takes of each document."""
    return mixing.mixture(docs)


STAGES = [("quality", good), ("near_duplicates", single), ("decontamination", clean), ("personal_data", private), ("mixing", mixed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir))
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
