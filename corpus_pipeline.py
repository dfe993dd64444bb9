"""Corpus pipeline: documents in, sharded training mix out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes every stage's result as
Parquet in the shared folder and reads it back as the next one's docs, so a lost executor costs a
stage's missing tasks at most. All stages but the last return the columns of documents.

1. quality: documents that the byte-level CNN scores below 0.5 go;
2. near_duplicates: of every SimHash group the document with the smallest id stays;
3. decontamination: documents that hold a benchmark item's template windows go;
4. mixing: every document is emitted as often as its source's rate says;
5. sharding: the copies are placed in 24 shards of near-equal bytes by a k-d tree.

The classifier and the fingerprints can't be stated in SQL, so there is no oracle; tests/llm holds
the run against brute force, stage by stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwise.llm import decontam, mixing, quality, sharding, simhash
from pitwise.llm.common import materialize

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
