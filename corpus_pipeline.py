"""From raw documents to sharded training data, in five written stages.

Each stage reads what its predecessor wrote and keeps the columns of ``documents``;
the last one adds ``slot`` and ``shard``.  A lost executor costs the running stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftline.llm import decontaminate, mixing, near_dup, sharding, toxicity
from weftline.llm.queries import SHARDS, SLOTS, table
from weftline.session import scratch_path

# The rule for stages, over word shingles of five; op8 has a threshold of its own.
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score(docs, model, out="_toxicity").where("_toxicity < 0.5").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    later = near_dup.near_duplicates(docs, percent=NEAR_PERCENT)
    later = later.where("id <> component").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(later, "doc_id", "left_anti").select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their target weights."""
    return mixing.mix(docs)


def place_on_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their slot and shard."""
    return sharding.assign(docs, "doc_id", SHARDS, SLOTS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", place_on_shards),
]

# The stages hold a trained model and MinHash; tests compare the run with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark)
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{number}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
