"""The corpus pipeline: five stages, each an operator of ``tillroll.llm``.

Every stage takes all that its predecessor kept, and its decisions take effect;
between stages the documents are written as Parquet and read again. All stages but
the last return the columns of ``documents``. Any stage takes no rows and gives none,
and other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontamination, mixing, near_duplicates, quality_rules, sharding
from tillroll.llm.scratch import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null and empty texts do, as they have
    no words; rows that repeat stay or go together."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays (five-word shingles): that with
    the smallest id, and of rows that repeat id and text one. Texts without words are
    like nothing, rows with a null id can't be named, and both stay."""
    return near_duplicates.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts hold none; rows that
    repeat stay or go together; null and empty items are held by none."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until their sources meet the targets. Null
    sources are one source, null texts have no words, and rows that repeat id and text
    are taken alike."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with size, text_crc32, shard and slot. Equal texts share a
    shard, null texts are one group, and rows that repeat get slots of their own."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: the stages are compared with brute force in tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
