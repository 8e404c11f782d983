"""Message streams, read in bulk or as a stream; any source with a ``value`` column serves."""

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, messages_per_batch: int | None = None) -> dict[str, str]:
    """The whole topic from its start, going on if old messages have expired.

    ``messages_per_batch`` drains a large backlog in several batches, so that a failure repeats only one.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if messages_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(messages_per_batch)
    return options


def read_messages(
    spark: SparkSession, source_format: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """All messages there are now."""
    if source_format == "kafka":
        options.setdefault("endingOffsets", "latest")
    return spark.read.format(source_format).options(**options).load(path)


def stream_messages(
    spark: SparkSession, source_format: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """The messages as an unbounded table."""
    return spark.readStream.format(source_format).options(**options).load(path)
