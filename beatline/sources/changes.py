"""Changed records of a table since a cursor.

A cursor is the pair (change time, ID) of the last record taken, kept as text in ``last_updated_on`` and
``last_id`` of a one-row table.  Records are ordered by change time, then ID: numbers first, by value, then other
IDs as text, of which a missing one is the first.  A record without a change time is after no cursor and never taken.

A record without an ID leaves ``last_id`` as it was; ``last_missing`` then says that the last record had none, so that
the cursor stands after all records of its time that have a number or no ID.  A cursor without that column was saved
after a record with an ID.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from beatline import schema
from beatline.commits import CommitLog
from beatline.functions.times import change_time, iso_text
from beatline.session import Staging

# The cursor before every record, and the number of records of one page.
START_TIME, START_ID = "1900-01-01T00:00:00", "0"
PAGE_SIZE = 50_000

_DAY = 24 * 60 * 60
_ID_BLOCK_BITS = 20
_CURSOR = "last_updated_on string, last_id string, last_missing boolean"


def _time_column(df: DataFrame, column: str) -> Column:
    """Text is parsed; a timestamp is taken as it is, so that the scan can skip older files."""
    is_text = df.schema[column].dataType.typeName() == "string"
    return change_time(F.col(column)) if is_text else F.col(column).cast("timestamp")


def _id_place(id_text: Column) -> Column:
    """Place of an ID among the records of one change time."""
    number = id_text.try_cast("bigint")
    other = F.when(number.isNull(), F.coalesce(id_text.cast("string"), F.lit("")))
    return F.struct(number.isNull().alias("other"), number.alias("number"), other.alias("text"))


def _missing_flag(cursor: DataFrame) -> Column:
    return F.coalesce("last_missing", F.lit(False)) if "last_missing" in cursor.columns else F.lit(False)


def keys(df: DataFrame) -> tuple[Column, Column]:
    """Change time and place of the ID of each record."""
    return _time_column(df, "Updated On"), _id_place(F.col("ID"))


def start_cursor(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit(START_TIME).alias("last_updated_on"), F.lit(START_ID).alias("last_id"), F.lit(False).alias("last_missing")
    )


def saved_cursors(spark: SparkSession, path: str) -> DataFrame:
    """The cursors of the history that are still kept, with their numbers; none before the first save."""
    log = CommitLog(spark, path)
    found = [(number, log.read(number)) for number in log.numbers()]
    rows = [
        (c["last_updated_on"], c["last_id"], c["last_missing"], datetime.fromisoformat(c["saved_at"]), number)
        for number, c in found
        if c is not None
    ]
    return spark.createDataFrame(rows, schema.CURSOR_SCHEMA)


def load_cursor(spark: SparkSession, path: str) -> DataFrame:
    """The cursor saved last; before the first save, the start cursor."""
    return numbered_cursor(spark, path)[1]


def numbered_cursor(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """Number and content of the cursor saved last; 0 and the start cursor before the first save."""
    number, saved = CommitLog(spark, path).newest()
    if saved is None:
        return 0, start_cursor(spark)
    row = (saved["last_updated_on"], saved["last_id"], bool(saved["last_missing"]))
    return number, or_start(spark.createDataFrame([row], _CURSOR))


def or_start(cursor: DataFrame) -> DataFrame:
    """The one-row cursor with the start where a part is missing or empty."""
    return cursor.agg(
        F.coalesce(F.max("last_updated_on"), F.lit(START_TIME)).alias("last_updated_on"),
        F.coalesce(F.nullif(F.max("last_id"), F.lit("")), F.lit(START_ID)).alias("last_id"),
        F.coalesce(F.bool_or(_missing_flag(cursor)), F.lit(False)).alias("last_missing"),
    )


def fixed(cursor: DataFrame) -> DataFrame:
    """The one-row cursor as a constant, computed now: what it was made from may change or go."""
    row = cursor.select("last_updated_on", "last_id", _missing_flag(cursor)).first()
    return cursor.sparkSession.createDataFrame([tuple(row)], _CURSOR)


def look_back(cursor: DataFrame, hours: int) -> DataFrame:
    """The cursor moved back some hours, before every ID; where its time cannot be read it stays."""
    if hours <= 0:
        return cursor
    moment = change_time(F.col("last_updated_on"))
    earlier = iso_text(moment - F.make_dt_interval(hours=F.lit(hours)))
    return cursor.select(
        F.coalesce(earlier, "last_updated_on").alias("last_updated_on"),
        F.when(moment.isNull(), F.col("last_id")).otherwise(START_ID).alias("last_id"),
        (moment.isNull() & _missing_flag(cursor)).alias("last_missing"),
    )


def _position(cursor: DataFrame) -> tuple[Column, Column]:
    """Time and ID of a one-row cursor, for use in a condition on another table."""
    place = _id_place(F.when(~_missing_flag(cursor), F.coalesce("last_id", F.lit(START_ID))))
    position = cursor.select(
        F.struct(change_time(F.col("last_updated_on")).alias("moment"), place.alias("place"))
    ).scalar()
    return position.getField("moment"), position.getField("place")


def changes_after(df: DataFrame, cursor: DataFrame) -> DataFrame:
    """Records after the cursor.

    The first condition alone bounds the change time, so it can reach the scan of a typed table.
    """
    moment, place = keys(df)
    last_moment, last_place = _position(cursor)
    return df.filter(moment >= last_moment).filter((moment > last_moment) | (place > last_place))


def changes_until(df: DataFrame, cursor: DataFrame) -> DataFrame:
    """Records up to and including the cursor."""
    moment, place = keys(df)
    last_moment, last_place = _position(cursor)
    return df.filter(moment <= last_moment).filter((moment < last_moment) | (place <= last_place))


def full_load(df: DataFrame) -> DataFrame:
    return changes_after(df, start_cursor(df.sparkSession))


def incremental_load(df: DataFrame, cursor: DataFrame, lookback_hours: int = 0) -> DataFrame:
    """All changes since the cursor, or everything while there is none."""
    return changes_after(df, look_back(or_start(cursor), lookback_hours))


def first_page(df: DataFrame, cursor: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """About the first ``size`` records after the cursor, in order.

    A page ends with all records that share the change time and ID of its last one, so that the next page, which
    begins after that pair, misses none; only such ties make it longer than ``size``.

    The records are read three times.  First their seconds are counted, into a table with a row per second, which tells
    the last second of the page; then the end of the page is looked for among the records of that second; then the page
    is read.  Where one second holds far more than a page, its blocks of IDs are counted before anything is
    sorted, so the sorts stay small even if one second holds most of the changes.
    """
    keyed = changes_after(df, cursor).withColumns(dict(zip(("_moment", "_place"), keys(df))))
    second = F.unix_seconds("_moment")
    staging = Staging(df.sparkSession)
    counts = keyed.select(second.alias("step")).groupBy("step").agg(F.count("*").alias("n"))
    counts = staging.write(counts, "seconds")
    # days first: a running count over days, then over the seconds of one day, each a row per step in one task
    days = counts.groupBy(F.floor(F.col("step") / _DAY).alias("step")).agg(F.sum("n").alias("n"))
    found = _last_step(days, size)
    if found is not None:
        day, before, _ = found
        last_second, further, at_once = _last_step(counts.filter(F.floor(F.col("step") / _DAY) == day), size - before)
        missing = size - before - further
        last = keyed.filter(second == last_second)
        if at_once > 4 * size:
            no_number = F.lit(2**62)  # records without a numeric ID come last
            block = F.coalesce(F.shiftright("_place.number", _ID_BLOCK_BITS), no_number)
            blocks = last.groupBy(block.alias("step")).agg(F.count("*").alias("n"))
            last_block, sooner, _ = _last_step(blocks, missing)
            last = last.filter(block == last_block)
            missing -= sooner
        micros = F.unix_micros("_moment").alias("micros")
        ends = last.select(F.struct(micros, "_place").alias("key")).orderBy("key").limit(missing)
        end = ends.agg(F.max("key").alias("key")).first()["key"]
        place = F.struct(
            F.lit(end["_place"]["other"]).alias("other"),
            F.lit(end["_place"]["number"]).cast("bigint").alias("number"),
            F.lit(end["_place"]["text"]).cast("string").alias("text"),
        )
        moment = F.timestamp_micros(F.lit(end["micros"]))
        keyed = keyed.filter(F.col("_moment") <= moment).filter((F.col("_moment") < moment) | (F.col("_place") <= place))
    staging.drop("seconds")
    return keyed.orderBy("_moment", "_place").drop("_moment", "_place")


def _last_step(counts: DataFrame, size: int) -> tuple[int, int, int] | None:
    """The step at which the rows counted in order of steps reach ``size``, the rows before it and in it; None if they never do.

    The running count goes over one row per step in one task: days, the seconds of a day, or the ID blocks of a second,
    a row per record at most where IDs are sparse.
    """
    running = F.sum("n").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = counts.withColumn("running", running).filter(F.col("running") >= size)
    row = reached.agg(F.min_by(F.struct("step", F.col("running") - F.col("n"), "n"), "step")).first()[0]
    return None if row is None else tuple(row)


def _exact_text(moment: Column) -> Column:
    """Change time as text, to the microsecond where it has a fraction."""
    whole = F.unix_micros(moment) % 1_000_000 == 0
    return F.when(whole, iso_text(moment)).otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def next_cursor(taken: DataFrame, cursor: DataFrame) -> DataFrame:
    """Cursor after the records taken; a part that no record has keeps its value."""
    moment, place = keys(taken)
    is_text = taken.schema["Updated On"].dataType.typeName() == "string"
    text = F.col("Updated On") if is_text else _exact_text(moment)
    known = F.coalesce(F.col("ID").cast("string"), F.lit("")) != ""
    position = F.struct(moment.alias("moment"), place.alias("place"))
    last = taken.agg(
        F.max(F.struct(moment.alias("moment"), text.alias("text"))).getField("text").alias("text"),
        F.max(F.when(known, position)).getField("place").alias("place"),
        F.max_by(~known, F.when(moment.isNotNull(), position)).alias("missing"),
    )
    old = or_start(cursor).select(F.struct("last_updated_on", "last_id", "last_missing")).scalar()
    last_id = F.coalesce(F.col("place.number").cast("string"), F.col("place.text"), old.getField("last_id"))
    return last.select(
        F.coalesce("text", old.getField("last_updated_on")).alias("last_updated_on"),
        last_id.alias("last_id"),
        F.coalesce("missing", old.getField("last_missing")).alias("last_missing"),
    )


def csv_last(columns: list[str], numeric_id: bool = False) -> Column:
    """Aggregate for the cursor after a CSV export: its greatest change time, and there the greatest ID.

    The change time is in ``Updated On`` or ``updated_on``.  IDs are compared as text, so ``9`` is after ``10``;
    ``numeric_id`` compares them as numbers; an export without IDs gives the start ID.  NULL where no row has a
    readable change time.
    """
    named = next((c for c in ("Updated On", "updated_on") if c in columns), None)
    moment = change_time(F.col(named) if named else F.lit(None).cast("string"))
    number = F.col("ID") if "ID" in columns else F.lit(START_ID)
    return F.max(
        F.when(
            moment.isNotNull(),
            F.struct(
                moment.alias("moment"),
                (number.try_cast("bigint") if numeric_id else number).alias("order"),
                iso_text(moment).alias("last_updated_on"),
                number.alias("last_id"),
            ),
        )
    )


def csv_cursor(rows: DataFrame, numeric_id: bool = False) -> DataFrame:
    """The cursor after a CSV export, to the second; no row where no change time can be read."""
    last = rows.agg(csv_last(rows.columns, numeric_id).alias("last")).filter(F.col("last").isNotNull())
    return last.select("last.last_updated_on", "last.last_id")
