"""Both message layouts, broken messages, restarts, and the quality counts."""

import json

import pytest
from pyspark.sql import functions as F

from beatline import schema
from beatline.operators import quality
from beatline.sources.messages import kafka_options, read_messages, stream_messages
from beatline.streaming import ingest

CSV = {"ID": "1", "Case Number": "C1", "Primary Type": "THEFT", "Location": "(41.5, -87.5)", "Arrest": "true"}
API = {
    "id": 2, "case_number": "C2", "primary_type": "ARSON", "arrest": True, "latitude": 41.25, "extra": [1],
    "location": {"latitude": "41.25", "longitude": "-87.5", "human_address": "x"},
}
MIXED = {"ID": "3", "id": "30", "case_number": "C3", "Location": None, "location": {"latitude": "1"}}
BROKEN = ["not json", "", "[1, 2]", '{"ID": "5", "Ca', None]


def messages(spark, texts):
    rows = spark.createDataFrame([(t if t is None or isinstance(t, str) else json.dumps(t),) for t in texts], "value string")
    return rows.withColumn("value", F.col("value").cast("binary"))


def parse(spark, *texts):
    return [r.asDict() for r in ingest.parse_messages(messages(spark, texts)).collect()]


def known(row):
    return {k: v for k, v in row.items() if v is not None}


def test_layouts(spark):
    csv, api, mixed = parse(spark, CSV, API, MIXED)
    assert list(csv) == schema.RAW_COLUMNS
    assert known(csv) == CSV
    assert known(api) == {
        "ID": "2", "Case Number": "C2", "Primary Type": "ARSON", "Arrest": "true", "Latitude": "41.25",
        "Location": '{"latitude":"41.25","longitude":"-87.5"}',
    }
    assert known(mixed) == {"ID": "3", "Case Number": "C3", "Location": '{"latitude":"1"}'}


@pytest.mark.parametrize("text", BROKEN)
def test_broken_messages_stay_as_empty_rows(spark, text):
    assert known(parse(spark, text)[0]) == {}


def test_quality_counts(spark):
    counts = quality.message_quality(messages(spark, [CSV, API, MIXED, *BROKEN])).first()
    assert counts["total_messages"] == 8
    assert counts["all_null_messages"] == 6  # the CSV layout and the five broken ones
    assert counts["parse_failed"] == 2  # empty and absent text
    assert counts["malformed"] >= 2
    offenders = quality.all_null_messages(messages(spark, [CSV, API, *BROKEN]))
    assert offenders.count() == 6


def test_stream_equals_bulk_and_restart_adds_nothing(spark, tmp_path):
    source, raw, checkpoint = (f"{tmp_path}/{part}" for part in ("messages", "raw", "checkpoint"))

    def deliver(*texts):
        rows = spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "value string")
        rows.coalesce(1).write.mode("append").text(source)

    def run():
        ingest.ingest(stream_messages(spark, "text", source), raw, checkpoint).awaitTermination()
        return spark.read.parquet(raw)

    deliver(CSV, "not json", "")
    assert run().count() == 3
    assert run().count() == 3
    deliver(API, MIXED)
    streamed = run()
    bulk = ingest.parse_messages(read_messages(spark, "text", source))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, bulk.collect()))
    assert streamed.filter(F.col("ID").isNotNull()).count() == 3


def test_kafka_options_read_the_whole_topic():
    options = kafka_options("broker:9092", "incidents")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"


def _parsers(df):
    """How often the plan that runs parses JSON."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


@pytest.mark.parametrize("text", ['{"id": "1"}', '{"ID": "1"}', "not json", "", None, "[]", "{}"])
def test_filters_on_parsed_messages_parse_once(spark, text):
    messages = spark.createDataFrame([(text,)], "value string").repartition(2)
    parsed = ingest.parse_messages(messages)
    found = quality.non_empty_rows(parsed)
    assert _parsers(found) == 1 == _parsers(parsed.filter("ID IS NOT NULL AND `Updated On` IS NOT NULL"))
    assert [r["ID"] for r in found.collect()] == (["1"] if text and "1" in text else [])
    assert [r.asDict() for r in parsed.filter("ID IS NULL").collect()] == ([] if text and "1" in text else [dict.fromkeys(parsed.columns)])
    assert _parsers(quality.all_null_messages(messages)) == 1
    known = text == '{"id": "1"}'
    assert [r["json_str"] for r in quality.all_null_messages(messages).collect()] == ([] if known else [text])
