"""Column helpers that the native operators share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SPACE_SEPARATED = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A lambda variable holds it, so that the optimizer cannot write the expression out at each place, or for each
    element of an array, where the body uses it.
    """
    return F.transform(F.array(value), body)[0]


def space_words(text: Column) -> Column:
    """Number of words between ASCII spaces; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_SEPARATED)), F.lit(0)).cast("long")


def digest_of(*columns: Column) -> Column:
    """MD5 of the columns' texts, an order that has nothing to do with the values."""
    return F.md5(F.concat_ws("/", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)))


def id_remainder(id_column: Column, divisor: int) -> Column:
    """CRC-32 of an ID written as text, modulo ``divisor``; a NULL ID counts as an empty text."""
    written = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(written.cast("binary")) % F.lit(divisor)


def on_plain_names(documents: DataFrame, function: Callable[..., DataFrame], *named: str) -> DataFrame:
    """``function`` of the rows under names that clash with nothing, and its rows under the old names.

    It also gets the new names of the columns ``named``.  So operators that add columns of their own work on tables that
    have columns of the same names, or of names that differ in case only.
    """
    old = documents.columns
    plain = documents.toDF(*(f"c{i}" for i in range(len(old))))
    lower = [name.lower() for name in old]
    found = function(plain, *(f"c{lower.index(name.lower())}" for name in named))
    return found.select(*plain.columns).toDF(*old)
