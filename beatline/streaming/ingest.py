"""From two JSON message layouts to the raw table."""

from pyspark.sql import DataFrame, functions as F, types as T

from beatline import schema


def _both_layouts() -> tuple[T.StructType, T.StructType]:
    """The fields of both layouts in one structure, by message name and by a name of their own.

    Messages tell ``ID`` from ``id`` but Spark columns do not, hence the second set of names.
    """
    csv_fields, api_fields = schema.raw_schema().fields, schema.api_schema().fields
    named = T.StructType(csv_fields + api_fields)
    renamed = T.StructType(
        [T.StructField(f"csv_{schema.snake_name(f.name)}", f.dataType) for f in csv_fields]
        + [T.StructField(f"api_{f.name}", f.dataType) for f in api_fields]
    )
    return named, renamed


def parse_messages(messages: DataFrame) -> DataFrame:
    """The 22 raw columns of every message: each from the CSV layout, else from the API layout.

    The text is parsed once for both layouts, whatever is done with the rows later: a filter on columns of a projection
    would be moved below it with the parsing written out for each column, and does not pass a generator.  Text that is no
    JSON object gives a row of NULLs.
    """
    named, renamed = _both_layouts()
    record = F.from_json(F.col("value").cast("string"), named).cast(renamed)
    fields = messages.select(F.inline(F.array(record)))

    def pick(column):
        name = schema.snake_name(column)
        api = F.col(f"api_{name}")
        return F.coalesce(f"csv_{name}", F.to_json(api) if column == "Location" else api).alias(column)

    return fields.select(*[pick(c) for c in schema.RAW_COLUMNS])


def ingest(messages: DataFrame, path: str, checkpoint: str, **trigger):
    """Start the stream that appends to the raw table; by default it takes what is there and stops.

    The file sink's log and the checkpoint make each message arrive once, whatever fails between.
    """
    return (
        parse_messages(messages)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
