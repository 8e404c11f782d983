"""Parsing and bucketing of incident times."""

from pyspark.sql import Column, functions as F

# Accepted formats of the incident date.
CSV_FORMAT = "MM/dd/yyyy hh:mm:ss a"
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

# Formats of the change time, one- and two-digit fields alike, fraction of 1-6 digits.
LENIENT_CSV_FORMAT = "M/d/yyyy h:m:s a"
LENIENT_CSV_24H_FORMAT = "M/d/yyyy H:m:s"
LENIENT_ISO_FORMAT = "yyyy-M-d'T'H:m:s[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]['Z']"
LENIENT_SPACE_FORMAT = "yyyy-M-d H:m:s"

# Spark's day numbers run from 1 = Sunday.
DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
WEEK_ORDER = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# First hour of each part of the day; hours before 5 belong to NIGHT.
DAY_PARTS = [(22, "NIGHT"), (17, "EVENING"), (12, "AFTERNOON"), (5, "MORNING"), (0, "NIGHT")]
SEASONS = {"WINTER": [12, 1, 2], "SPRING": [3, 4, 5], "SUMMER": [6, 7, 8], "FALL": [9, 10, 11]}


def _try_format(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern))


def csv_time(text: Column) -> Column:
    """Incident date in the CSV layout only."""
    return F.when(text.contains("/"), _try_format(text, CSV_FORMAT))


def incident_time(text: Column) -> Column:
    """Incident date in the CSV or one of the two ISO layouts, else NULL.

    A slash or a dot tells which single format can match, so no row pays for failed attempts.
    """
    return (
        F.when(text.contains("/"), _try_format(text, CSV_FORMAT))
        .when(text.contains("."), _try_format(text, ISO_MILLIS_FORMAT))
        .otherwise(_try_format(text, ISO_FORMAT))
    )


def change_time(text: Column) -> Column:
    """Change time in any of seven layouts, surrounding white space ignored; ``Z`` is only a letter.

    Text as long as the usual layout is tried in that first, which is cheaper than the lenient formats.
    """
    trimmed = F.upper(F.btrim(text, F.lit(" \t\n\r\f\u000b")))
    lenient = (
        F.when(trimmed.contains("/") & trimmed.endswith("M"), _try_format(trimmed, LENIENT_CSV_FORMAT))
        .when(trimmed.contains("/"), _try_format(trimmed, LENIENT_CSV_24H_FORMAT))
        .when(trimmed.contains("T"), _try_format(trimmed, LENIENT_ISO_FORMAT))
        .otherwise(_try_format(trimmed, LENIENT_SPACE_FORMAT))
    )
    usual = F.when(F.length(text) == len("yyyy-MM-ddTHH:mm:ss.SSS"), _try_format(text, ISO_MILLIS_FORMAT))
    return F.coalesce(usual, lenient)


def iso_text(moment: Column) -> Column:
    """Change time as text, to the second."""
    return F.date_format(moment, ISO_FORMAT)


def day_part(hour: Column) -> Column:
    chain = F
    for first_hour, name in DAY_PARTS:
        chain = chain.when(hour >= first_hour, name)
    return chain.otherwise("NIGHT")


def season(month: Column) -> Column:
    chain = F
    for name, months in SEASONS.items():
        chain = chain.when(month.isin(months), name)
    return chain.otherwise("FALL")


def in_night(hour: Column, start: int = 22, end: int = 4) -> Column:
    """From ``start`` through midnight up to, not including, ``end``."""
    return (hour >= start) | (hour < end)


def day_name(day_of_week: Column) -> Column:
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return F.when(day_of_week.isNotNull(), F.element_at(names, day_of_week))


def is_weekend(day_of_week: Column) -> Column:
    return day_of_week.isin(1, 7)
