"""Publish changed records and move the cursor."""

from pyspark.sql import DataFrame, Observation, SparkSession

from beatline.sinks.messages import as_messages, publish
from beatline.sinks.tables import save_cursor
from beatline.sources import changes
from beatline.sources.tables import read_csv


def run_increment(
    table: DataFrame, cursor_path: str, lookback_hours: int = 0, full: bool = False, **sink
) -> DataFrame:
    """Publish what changed since the saved cursor, then save the new one, which is returned.

    The end of the increment is fixed before anything is sent and records after it wait for the next run,
    so a record that arrives meanwhile is neither lost nor skipped.  The cursor is saved after the data:
    a crash in between sends records again, and the cleaning keeps one of each.  Of two runs at once the second to
    end is refused with ``CommitConflict``; it has sent its records too.
    """
    spark = table.sparkSession
    number, saved = changes.numbered_cursor(spark, cursor_path)
    if full:
        saved = changes.start_cursor(spark)
    changed = changes.incremental_load(table, saved, lookback_hours)
    until = changes.fixed(changes.next_cursor(changed, saved))
    publish(as_messages(changes.changes_until(changed, until), keep_nulls=False), **sink)
    save_cursor(until, cursor_path, after=number)
    return until


def run_csv_bootstrap(
    spark: SparkSession,
    csv_path: str,
    cursor_path: str,
    max_rows: int | None = None,
    multi_line: bool = False,
    numeric_id: bool = False,
    table: DataFrame | None = None,
    **sink,
) -> DataFrame:
    """Publish a CSV export and save the cursor after it; ``run_increment`` goes on from there, at once if ``table`` is given.

    The cursor is observed on the rows as they are sent, so the export is read once.  Without a readable
    change time no cursor is saved.  An export without IDs is sent under the numbers of its rows, from 1.
    """
    seen = Observation("csv")
    # a header line tells whether there are IDs
    numbered = None if "ID" in read_csv(spark, csv_path, multi_line=multi_line).columns else "_row"
    rows = read_csv(spark, csv_path, max_rows, multi_line, row_number=numbered)
    rows = rows.observe(seen, changes.csv_last(rows.columns, numeric_id).alias("last"))
    publish(as_messages(rows, row_number=numbered), **sink)
    last = seen.get["last"]
    found = [] if last is None else [(last["last_updated_on"], last["last_id"])]
    cursor = spark.createDataFrame(found, "last_updated_on string, last_id string")
    if found:
        save_cursor(cursor, cursor_path)
    return cursor if table is None else run_increment(table, cursor_path, **sink)
