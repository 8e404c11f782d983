"""The corpus from documents to shards: each stage works on all that the one before it kept."""

from pyspark.sql import DataFrame, SparkSession

from beatline.llm import chosen_path, decontamination, mixing, sharding, toxicity
from beatline.llm.columns import id_remainder, space_words
from beatline.session import apply_settings, staged

SHARDS = 24


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels, lambda key: id_remainder(key, 4) != 2)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by similarities of 0.8 or more on five words."""
    return chosen_path.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    return decontamination.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; words are what is weighed."""
    return mixing.mixed_rows(docs, space_words)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard, their place in it, and what the shard operator tells of each."""
    return sharding.shard_rows(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_copies", near_copies_stage),
    ("benchmark", benchmark_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# The toxicity scores come out of a model, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written before the next stage reads it."""
    docs = apply_settings(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
