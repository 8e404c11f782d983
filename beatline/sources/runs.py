"""Stored documents of model trainings."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from beatline import schema


def read_runs(spark: SparkSession, path: str, source_format: str = "parquet") -> DataFrame:
    return spark.read.format(source_format).schema(schema.RUN_SCHEMA).load(path)


def latest_runs(runs: DataFrame, task_type: str, limit: int = 20) -> DataFrame:
    """A task's newest runs, newest first, with ``created_at`` also as a timestamp."""
    return (
        runs.filter(F.col("task_type") == task_type)
        .withColumn("created_at_ts", F.col("created_at").try_cast("timestamp"))
        .orderBy(F.desc_nulls_last("created_at_ts"), F.desc("created_at"), F.desc("metrics"))
        .limit(limit)
    )


def latest_run(runs: DataFrame, task_type: str) -> DataFrame:
    return latest_runs(runs, task_type, limit=1)
