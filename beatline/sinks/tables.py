"""Table writers."""

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from beatline.commits import CommitLog
from beatline.session import Staging, discard

# Fixed value: most rows in one file of the processed table.
ROWS_PER_FILE = 500_000

FILE_FORMATS = {"parquet", "orc", "json", "csv"}


def write_processed(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, only_years: bool = False) -> None:
    """Replace the processed table, one folder per year; with ``only_years`` the folders of years that have rows here.

    Rebalancing by year lets adaptive execution give a large year many tasks and put small years
    together, so files are neither many and tiny nor one per year.  It needs ``spark.sql.adaptive.enabled``.
    """
    (
        df.hint("rebalance", F.col("Year"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("partitionOverwriteMode", "dynamic" if only_years else "static")
        .partitionBy("Year")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_result(df: DataFrame, path: str | None = None, sink_format: str = "parquet", **options: str) -> None:
    """Replace a result collection; ``sink_format`` may name any connector on the class path.

    Files go to a new folder under ``path``, and a commit that names it is added when they are complete: a reader
    (``read_result``) sees the old rows or the new ones, whatever fails.  The two newest versions stay, so that a reader that has begun can
    end.  A connector that is no file format replaces as it knows how.
    """
    if sink_format not in FILE_FORMATS:
        df.write.mode("overwrite").format(sink_format).options(**options).save(path)
        return
    log = CommitLog(df.sparkSession, path)
    number, current = log.newest()
    version = f"version-{uuid.uuid4().hex}"
    df.write.format(sink_format).options(**options).save(f"{path}/{version}")
    log.add({"version": version, "format": sink_format}, after=number)
    log.delete_beside({version, current["version"]} if current else {version})


def upsert_processed(changed: DataFrame, path: str) -> None:
    """Put processed rows into the processed table: each replaces the row with its ID, whatever year that was in.

    Only the folders of years that gain or lose a row are written again; a table of all years is read for the IDs alone.
    The new years are written aside first, as they are read from the folders that they replace.  A run that failed before that can
    be repeated, also one that left a row in its old year.  Folders are swapped one after the other at the end: a crash in just that
    moment calls for a rebuild by ``run_etl``.
    """
    spark = changed.sparkSession
    staging = Staging(spark)
    changed = staging.write(changed, "changed")
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        write_processed(changed, path)
        staging.drop("changed")
        return
    ids = changed.select("ID")
    left = stored.select("ID", "Year").join(ids, "ID", "left_semi").select("Year")
    years = [row["Year"] for row in left.union(changed.select("Year")).distinct().collect()]
    touched = stored.where(F.col("Year").isin(years))
    kept = touched.join(ids, "ID", "left_anti").select(*changed.columns)
    fresh = staging.write(kept.unionByName(changed), "fresh")
    write_processed(fresh, path, only_years=True)
    # a year whose last row has moved away has nothing to be overwritten by
    held = {row["Year"] for row in fresh.select("Year").distinct().collect()}
    discard(spark, *(f"{path}/Year={year}" for year in years if year not in held))
    staging.drop("changed", "fresh")


def append_run(run: DataFrame, path: str | None = None, sink_format: str = "parquet", **options: str) -> None:
    """Add one training's document to the stored runs."""
    run.write.mode("append").format(sink_format).options(**options).save(path)


def save_cursor(cursor: DataFrame, path: str, after: int | None = None) -> int:
    """Add the cursor to its history under the next number, which is returned; the one with the highest number counts.

    ``after`` is the number of the cursor that this one goes on from: if another writer has saved one since, this
    one is refused with ``CommitConflict``.  A crash between data and cursor repeats records rather than losing them, and a
    crash while saving leaves the cursor before it.  The newest hundred cursors stay.
    """
    row = cursor.first().asDict()
    content = {name: row.get(name) for name in ("last_updated_on", "last_id", "last_missing")}
    saved_at = datetime.now(timezone.utc).isoformat(timespec="milliseconds")
    return CommitLog(cursor.sparkSession, path).add(content | {"saved_at": saved_at}, after)
