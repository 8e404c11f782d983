"""Records as keyed JSON messages."""

from pyspark.sql import DataFrame, functions as F

from beatline import schema


def as_messages(
    df: DataFrame, keep_nulls: bool = True, key: str = "ID", row_number: str | None = None
) -> DataFrame:
    """``key`` and ``value`` of every record.

    A table without the key column takes ``row_number`` as the key; that column is no part of the value.  Without either
    rows are numbered uniquely, with gaps between tasks.
    """
    number = F.col(row_number) if row_number else F.monotonically_increasing_id()
    record_key = (F.col(key) if key in df.columns else number).cast("string")
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    fields = [c for c in df.columns if c != row_number]
    return df.select(record_key.alias("key"), F.to_json(F.struct(*fields), options).alias("value"))


def api_layout(df: DataFrame) -> DataFrame:
    """Raw columns under their API names, the position nested; for messages without NULL fields."""
    place = F.struct(F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"))
    names = [F.col(c).alias(schema.snake_name(c)) for c in df.columns if c != "Location"]
    return df.select(*names, F.when(F.col("Latitude").isNotNull(), place).alias("location"))


def publish(messages: DataFrame, sink_format: str = "kafka", path: str | None = None, **options: str) -> None:
    """Send the messages; Kafka takes ``key`` and ``value``, a text sink the value alone."""
    if sink_format == "text":
        messages = messages.select("value")
    messages.write.mode("append").format(sink_format).options(**options).save(path)
