"""Text to typed values where bad text becomes NULL, with ANSI mode on or off."""

from pyspark.sql import Column, functions as F

_NUMBER = r"^\s*[+-]?[0-9]+([.][0-9]*)?\s*$"
_FRACTION_ONLY = r"^\s*[+-]?[.][0-9]*\s*$"


def safe_int(text: Column) -> Column:
    """``'12'``, ``'012'`` and ``'12.7'`` give 12, ``'.5'`` gives 0; what is no number gives NULL.

    The text is searched before it is cast: a cast that fails costs many times as much as one that works.
    """
    whole = F.substring_index(text, ".", 1).try_cast("int")
    return F.when(text.rlike(_NUMBER), whole).when(text.rlike(_FRACTION_ONLY), 0)


def safe_double(text: Column) -> Column:
    """Bad text gives NULL; empty text, the usual sign of a missing value, is not tried."""
    return F.when(F.trim(text) != "", text.try_cast("double"))


def text_flag(text: Column) -> Column:
    """``true``/``false`` in any case; all else, padded text included, is NULL."""
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
