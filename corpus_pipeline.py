"""The training-data pipeline: five stages over ``documents``, each stored before the next reads it.

quality    line-first rules; failing lines are removed, documents that lose too much go
near       one document of each near-duplicate group (0.8) stays, the one with the smallest id
benchmark  documents with a passage of the benchmark go
mixing     documents are taken up to the token budgets of a weighted source tree
shards     every document that is left gets its shard
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import decontaminate, mixing, near, quality, query_mixing, query_sharding, sharding
from palimpsest.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Columns of ``docs``; text and n_chars are those of the lines that pass."""
    return quality.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs``: the smallest id of each group."""
    return near.one_of_each(docs, percent=near.CLEAN)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs`` without a window like a benchmark item."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs`` within four fifths of their tokens, by the weights of op3; no repeats."""
    return mixing.taken(
        docs, budget=F.expr("sum(tokens) * 4 div 5"), weights=query_mixing.WEIGHTS,
        domain=query_mixing.domain(), epochs=1, seed=query_mixing.SEED)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs`` with row_bytes, shard, depth and shard_bytes."""
    return sharding.extendible_shards(docs, query_sharding.SHARD_BYTES)


STAGES = [
    ("quality", quality_rules), ("near", near_duplicates), ("benchmark", decontamination),
    ("mixing", source_mixing), ("shards", shards)]

# One-permutation MinHash and SimHash have no SQL form; the stages are tested against
# brute force, and op3, op6, op7 and op8 against SQL of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
