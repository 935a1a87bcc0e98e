"""The corpus pipeline: five stages over ``documents``, each written and read again.

quality classifier -> near-duplicate groups -> benchmark decontamination -> source mixing -> sharding.
Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and all but the last
return the columns of ``documents``. Null texts, nulls in other columns, empty tables and extra columns
pass through the stages as their operators define.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from reviewkit.llm.partition_join import jaccard_components
from reviewkit.llm.poisson_mix import replicate
from reviewkit.llm.pu_quality import score_quality
from reviewkit.llm.queries import MIX_WEIGHTS, SHARDS
from reviewkit.llm.slots import assign_shards
from reviewkit.llm.suffix_decontam import decontaminate
from reviewkit.session import scratch_path

#: Near duplicates: five-word shingles, Jaccard 0.8.
SHINGLE_WORDS, SIMILARITY = 5, 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts."""
    scored = score_quality(docs, _table(spark, sf_dir, "labels"), keep=True)
    return scored.where("__pu_predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group.

    Null and repeated ids are judged by row. Documents without words are no duplicates of anything and stay.
    """
    return jaccard_components(docs, SHINGLE_WORDS, SIMILARITY, keep=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=True)
    return found.where("not __contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources meet their target weights, in global random order."""
    return replicate(docs, MIX_WEIGHTS).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return assign_shards(docs, SHARDS, keep=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: The classifier is trained and the near-duplicate join compares sets: no SQL. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored as parquet in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
