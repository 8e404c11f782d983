"""Parquet tables and CSV exports."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from beatline.commits import CommitLog
from beatline.session import staged


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_processed(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """The processed table; ``years`` reads only the folders of those years."""
    df = spark.read.parquet(path)
    return df if years is None else df.filter(F.col("Year").isin(years))


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a result collection."""
    _, current = CommitLog(spark, path).newest()
    if current is None:
        raise FileNotFoundError(f"no result has been published at {path}")
    return spark.read.format(current["format"]).load(f"{path}/{current['version']}")


def read_csv(
    spark: SparkSession, path: str, max_rows: int | None = None, multi_line: bool = False, row_number: str | None = None
) -> DataFrame:
    """A CSV export with a header, every column text, empty fields as empty text.

    Quotes inside a field are doubled.  Files whose header differs from the first one's fail rather than mix up their
    columns: read each layout by itself.  ``multi_line`` allows line breaks inside quoted fields; such files
    cannot be split over tasks, so it is off unless asked for.

    ``row_number`` names a column for the rows' numbers in the export, from 1 without gaps, files in order of their paths;
    ``max_rows`` keeps the rows with the first numbers.  Both need the rows written once to the shared folder: each task
    counts the rows of its part of a file, and what comes before a part is the sum over the parts before, so no task sees all rows.
    """
    rows = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .csv(path)
    )
    if max_rows is None and row_number is None:
        return rows.na.fill("")
    columns = rows.columns
    number = row_number or "_row"
    numbered = _numbered(rows, number)
    if max_rows is not None:
        numbered = numbered.where(F.col(number) <= max_rows)
    return numbered.select(*(F.coalesce(f"`{c}`", F.lit("")).alias(c) for c in columns), *([number] if row_number else []))


def _numbered(rows: DataFrame, number: str) -> DataFrame:
    """Rows of files with their numbers in the order of paths and places in the files."""
    part = ["_file", "_start"]
    # numbers inside a task ascend by one, and a part of a file is read by one task from its start to its end
    held = staged(
        rows.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "csv-rows",
    )
    parts = held.groupBy(*part).agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    before = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select(*part, "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_begin"))
    place = (F.col("_begin") + F.col("_at") - F.col("_first") + 1).cast("long")
    return held.join(begins, part).withColumn(number, place)
