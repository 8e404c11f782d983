"""Raw table to processed table."""

from pyspark.sql import DataFrame, SparkSession

from beatline.operators.clean import clean
from beatline.operators.features import enrich
from beatline.sinks.tables import upsert_processed, write_processed
from beatline.sources.tables import read_raw


def process(raw: DataFrame) -> DataFrame:
    return raw.transform(clean).transform(enrich)


def run_etl(spark: SparkSession, raw_path: str, processed_path: str) -> dict[str, int]:
    """Rebuild the processed table, and count the rows of both.

    The counts are of the files that are there, so a repeated task counts nothing twice, and they read no column: a count
    of a Parquet table takes the row counts of its footers.
    """
    write_processed(process(read_raw(spark, raw_path)), processed_path)
    return {"raw_rows": stored_rows(spark, raw_path), "processed_rows": stored_rows(spark, processed_path)}


def run_upsert(spark: SparkSession, raw_path: str, processed_path: str) -> None:
    """Process a delivery of raw records and put the result into the processed table.

    The delivery must hold every copy of its records that is to be ranked: a later delivery's record replaces an earlier one's.
    """
    upsert_processed(process(read_raw(spark, raw_path)), processed_path)


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, from the footers of its files."""
    return spark.read.parquet(path).count()
