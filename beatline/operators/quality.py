"""Counts of empty and unreadable records, each in one pass."""

from pyspark.sql import Column, DataFrame, functions as F

from beatline import schema

CORRUPT = "_corrupt_record"


def _nothing_known(columns: list[Column]) -> Column:
    return F.coalesce(*columns).isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Rows in total, rows where every column is NULL, and the others."""
    empty = _nothing_known([F.col(f"`{c}`") for c in df.columns])
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(empty).alias("all_null_rows"),
        F.count_if(~empty).alias("not_all_null_rows"),
    )


def non_empty_rows(df: DataFrame) -> DataFrame:
    return df.filter(~_nothing_known([F.col(f"`{c}`") for c in df.columns]))


def read_as_api(messages: DataFrame) -> DataFrame:
    """Message text with its reading under the API layout and whether that left nothing.

    The reading passes a generator, below which no filter on it is moved, so that each text is parsed once.
    """
    layout = schema.api_schema().add(CORRUPT, "string")
    text = messages.select(F.col("value").cast("string").alias("json_str"))
    reading = F.from_json("json_str", layout, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = text.select("json_str", F.explode(F.array(reading)).alias("data"))
    fields = [F.col(f"data.{f.name}") for f in schema.api_schema().fields if f.name != "location"]
    return parsed.withColumn("all_null", _nothing_known(fields + [F.to_json("data.location")]))


def message_quality(messages: DataFrame) -> DataFrame:
    """Total, all-null and failed messages under the API layout.

    Text that is no JSON still gives a record of NULLs, so ``parse_failed`` sees only absent or empty text;
    ``malformed`` counts the text that is no JSON.  Messages in the CSV layout are all-null here.
    """
    return read_as_api(messages).agg(
        F.count("*").alias("total_messages"),
        F.count_if("all_null").alias("all_null_messages"),
        F.count_if(F.col("data").isNull()).alias("parse_failed"),
        F.count_if(F.col(f"data.{CORRUPT}").isNotNull()).alias("malformed"),
    )


def all_null_messages(messages: DataFrame) -> DataFrame:
    return read_as_api(messages).filter("all_null").select("json_str")
