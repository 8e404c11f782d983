"""Time, place, offence and risk features of a clean incident."""

from pyspark.sql import DataFrame, functions as F

from beatline import schema
from beatline.functions import offences, times
from beatline.operators.clean import require_columns


def add_time_features(df: DataFrame) -> DataFrame:
    """Parse the date, drop rows without one, and take ``Year`` from it."""
    moment = F.col("crime_datetime")
    return (
        df.withColumn("crime_datetime", times.incident_time(F.col("Date")))
        .transform(require_columns, ["crime_datetime"])
        .withColumns(
            {
                "crime_year": F.year(moment),
                "crime_month": F.month(moment),
                "crime_day": F.dayofmonth(moment),
                "crime_hour": F.hour(moment),
                "crime_day_of_week": F.dayofweek(moment),
            }
        )
        .withColumns(
            {
                "Year": F.col("crime_year"),
                "time_of_day": times.day_part(F.col("crime_hour")),
                "season": times.season(F.col("crime_month")),
            }
        )
    )


def add_incident_features(df: DataFrame, night: tuple[int, int] = (22, 4)) -> DataFrame:
    """Classify place and offence; a table without Arrest or Domestic counts them as False."""

    present = set(df.columns)

    def flag(column):
        return F.col(column) if column in present else F.lit(False)

    place, offence = F.col("location_category"), F.col("Primary Type")
    return df.withColumns(
        {
            "location_category": offences.place_category(F.col("Location Description")),
            "crime_category": offences.crime_category(offence),
            "crime_severity_level": offences.severity_level(offence),
            "crime_severity_weight": offences.severity_weight(offence),
            "is_night": times.in_night(F.col("crime_hour"), *night),
            "was_arrest_made": flag("Arrest"),
            "is_domestic_incident": flag("Domestic"),
        }
    ).withColumns(
        {
            "location_risk_weight": offences.place_weight(place),
            "is_violent": F.col("crime_category") == "Violent Crime",
            "is_public_space": offences.is_public_place(place),
        }
    )


def add_risk_score(df: DataFrame) -> DataFrame:
    raw = offences.raw_risk(
        F.col("crime_severity_weight"),
        F.col("location_risk_weight"),
        F.col("is_night"),
        F.col("is_domestic_incident"),
        F.col("is_public_space"),
    )
    return df.withColumn("risk_score", offences.risk_score(raw))


def processed_columns(df: DataFrame) -> DataFrame:
    """The processed table's columns, as far as the input has them."""
    present = set(df.columns)
    return df.select(*[c for c in schema.PROCESSED_COLUMNS if c in present])


def enrich(df: DataFrame) -> DataFrame:
    """All features on a clean table."""
    return (
        df.transform(add_time_features)
        .transform(add_incident_features)
        .transform(add_risk_score)
        .transform(processed_columns)
    )
