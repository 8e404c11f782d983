"""From raw text rows to one typed row per incident."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from beatline import schema
from beatline.functions.casts import safe_double, safe_int, text_flag
from beatline.functions.times import change_time


def require_columns(df: DataFrame, columns: list[str] = schema.REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows where a required column is NULL or no number; empty text stays.

    One condition per column, unlike ``dropna``, reaches the scan as a filter.
    """
    for column in columns:
        known = F.col(column).isNotNull()
        if df.schema[column].dataType in (T.DoubleType(), T.FloatType()):
            known = known & ~F.isnan(column)
        df = df.filter(known)
    return df


def tie_order(df: DataFrame, portable: bool = False) -> list[Column]:
    """An order of rows that are alike in time, case number and date: by the values of all columns, by name."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    if portable:
        parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in columns]
        return [F.sha2(F.concat_ws("\u0001", *parts), 256)]
    # 128 bits of the values as they are; whether one is NULL counts too, as hashes pass over NULLs
    known = F.concat(*(F.when(c.isNull(), "0").otherwise("1") for c in columns))
    return [F.xxhash64(known, *columns), F.xxhash64(F.lit("ties"), known, *columns)]


def latest_per_id(df: DataFrame, portable_ties: bool = False) -> DataFrame:
    """One row per ID: the last by change time, then case number, then date text, then by hashes of all columns.

    The order is total (rows equal in all columns may stand for each other), so the row kept does not depend on
    files, partitions or repeated tasks.  ``portable_ties`` ranks ties by a SHA-256 of the columns' texts, which other engines can
    repeat, at several times the cost.

    Each task keeps one row per ID before the shuffle, so an ID with a large share of the rows sends one
    row per task; columns nobody asks for later are read for the hashes only and pruned below the shuffle.
    """
    order = []
    if "Updated On" in df.columns:
        order.append(change_time(F.col("Updated On")).desc_nulls_last())
    order += [F.col(c).desc_nulls_last() for c in ("Case Number", "Date") if c in df.columns]
    newest_first = Window.partitionBy("ID").orderBy(*order, *tie_order(df, portable_ties))
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def type_columns(df: DataFrame) -> DataFrame:
    """Cast numbers and flags; columns that are absent are left out, bad text becomes NULL."""
    casts = [(schema.INT_COLUMNS, safe_int), (schema.DOUBLE_COLUMNS, safe_double), (schema.FLAG_COLUMNS, text_flag)]
    present = set(df.columns)
    return df.withColumns({c: cast(F.col(c)) for columns, cast in casts for c in columns if c in present})


def clean(df: DataFrame) -> DataFrame:
    return df.transform(require_columns).transform(latest_per_id).transform(type_columns)
