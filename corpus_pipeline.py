"""The corpus pipeline: five stages, each written as Parquet and reread by the next.

The classifier drops what it rejects, SimHash keeps one document of each group, documents
that hold a benchmark passage go, the sources are mixed to their target weights (a document
may then come up to three times), and every row gets its shard, in ``shard`` or, if the
documents have such a column in any case, under a fresh name (``_shard``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyrow.llm import decontaminate, mixing, quality, sharding, simhash
from tallyrow.llm.common import fresh
from tallyrow.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.with_shard(docs, name=fresh(docs, "shard"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", remove_benchmark),
    ("mixing to target weights", mix),
    ("sharding", shard),
]

#: The first stage trains a model, which SQL does not express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
