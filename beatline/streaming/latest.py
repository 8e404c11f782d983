"""The latest record of each ID, kept up to date by a stream."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from beatline.functions.times import change_time
from beatline.operators.clean import latest_per_id, tie_order


def latest_changes(records: DataFrame, delay: str = "7 days", span: str = "1 day") -> DataFrame:
    """Of each ID and ``span`` of change time the last record, sent again when a later one of that span arrives.

    The state is one record per ID and span until the watermark, ``delay`` behind the latest change time seen, has passed the span; so it is bounded
    by the changes of that time.  Records that are later than that are dropped by Spark, which counts them
    (``numRowsDroppedByWatermark``), as are records without an ID or a readable change time, which have no place here.
    Copies are ranked as by ``latest_per_id``.
    """
    known = records.where(F.col("ID").isNotNull()).withColumn("_changed", change_time(F.col("Updated On")))
    known = known.where(F.col("_changed").isNotNull()).withWatermark("_changed", delay)
    columns = [c for c in records.columns]
    # the first by the hashes is the greatest by their complements
    ties = [F.bitwise_not(h).alias(f"tie{i}") for i, h in enumerate(tie_order(records))]
    order = F.struct("_changed", *(F.col(c) for c in ("Case Number", "Date") if c in columns), *ties)
    last = F.max_by(F.struct(*(F.col(f"`{c}`") for c in columns)), order)
    grouped = known.groupBy(F.window("_changed", span).alias("_span"), F.col("ID").alias("_key"))
    return grouped.agg(last.alias("_last")).select("_last.*")


def follow_latest(records: DataFrame, path: str, checkpoint: str, delay: str = "7 days", **trigger):
    """Start the stream that keeps the records for ``read_latest``; by default it takes what is there and stops.

    Each micro-batch is a folder of its own, so that one that is repeated after a failure replaces what it had left.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        latest_changes(records, delay)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """One row per ID: the last of those that the stream has sent."""
    return latest_per_id(spark.read.parquet(path).drop("batch"))
