"""Incident tables derived from the ``events`` table, every event giving one record."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from beatline import schema
from beatline.functions import times

# Texts that the derived records take in turn.
LOCATIONS = [
    "STREET",
    "RESIDENCE",
    "APARTMENT",
    "SIDEWALK",
    "PARKING LOT/GARAGE(NON.RESID.)",
    "SMALL RETAIL STORE",
    "RESTAURANT",
    "SCHOOL, PUBLIC, BUILDING",
    "CTA TRAIN",
    "BARBERSHOP",
    "WAREHOUSE",
    "JUNK YARD",
    "COMMERCIAL / BUSINESS OFFICE",
    "FACTORY/MANUFACTURING BUILDING",
    "DRIVEWAY - RESIDENTIAL",
    "PARK PROPERTY",
    "BOWLING ALLEY",
    "GAS STATION",
    "alley",
    "BANK",
    "POLICE FACILITY/VEH PARKING LOT",
    "TRUCKING TERMINAL",
    "CONSTRUCTION SITE",
    "",
]
PRIMARY_TYPES = [
    "THEFT",
    "BATTERY",
    "HOMICIDE",
    "NARCOTICS",
    "GAMBLING",
    "ARSON",
    "PROSTITUTION",
    "BURGLARY",
    "WEAPONS VIOLATION",
    "ASSAULT",
    "OTHER OFFENSE",
    "MOTOR VEHICLE THEFT",
    "crim sexual assault",
    "",
]
CRIME_CLASSES = [
    "Violent Crime",
    "Property Crime",
    "Drug/Weapon Crime",
    "Public Order Crime",
    "Other Crime",
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _nth(texts: list[str], index: str) -> str:
    quoted = ", ".join("'" + text + "'" for text in texts)
    return f"element_at(array({quoted}), cast({index} + 1 as int))"


# How an event becomes a raw record; columns that are not named here are NULL.
_RAW_RULES = {
    "ID": "cast(event_id - int(event_id % 20 = 19) as string)",
    "Case Number": "concat('C', event_id)",
    "Date": f"""case when event_id % 97 = 5 then 'n/a'
        when event_id % 3 = 0 then date_format(moved, '{times.CSV_FORMAT}')
        when event_id % 3 = 1 then date_format(moved, "yyyy-MM-dd'T'HH:mm:ss'.000'")
        else date_format(moved, "{times.ISO_FORMAT}") end""",
    "Primary Type": f"if(event_id % 101 = 7, null, {_nth(PRIMARY_TYPES, 'event_id % 14')})",
    "Description": "event_type",
    "Location Description": f"if(event_id % 53 = 3, null, {_nth(LOCATIONS, '(event_id * 7 + user_id) % 24')})",
    "Arrest": """case when event_id % 41 = 4 then null when event_type = 'purchase' then 'true'
        when event_type = 'error' then 'TRUE' when event_id % 43 = 2 then 'maybe' else 'false' end""",
    "Domestic": "case when event_id % 37 = 6 then null when user_id % 5 = 0 then 'true' else 'False' end",
    "District": """case when user_id % 29 = 28 then null when event_id % 47 = 0 then ''
        when event_id % 2 = 0 then lpad(user_id % 25 + 1, 3, '0') else concat(user_id % 25 + 1, '.0') end""",
    "Community Area": "if(user_id % 31 = 30, null, cast(user_id % 77 + 1 as string))",
    "Year": "cast(year(moved) as string)",
    "Updated On": """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'.000'")""",
    "Latitude": "if(event_id % 67 = 8, null, concat('41.', 600 + event_id % 400))",
    "Longitude": "if(event_id % 67 = 8, null, concat('-87.', 500 + user_id % 150 * 3))",
}


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table, 22 text columns with duplicates, gaps and dates in three layouts, and ``event_id``."""
    moved = events(spark, sf_dir).selectExpr(
        "*", "ts + make_ym_interval(0, cast(event_id % 30 as int)) as moved"
    )
    rules = [f"{_RAW_RULES.get(c, 'cast(null as string)')} as `{c}`" for c in schema.RAW_COLUMNS]
    return moved.selectExpr(*rules, "event_id")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per raw record: broken, empty, API layout or CSV layout."""
    raw = raw_incidents(spark, sf_dir)
    event = F.col("event_id")
    titles = F.to_json(F.struct(*schema.RAW_COLUMNS), {"ignoreNullFields": "false"})
    place = F.struct(F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"))
    snakes = {schema.snake_name(c): F.col(c) for c in schema.RAW_COLUMNS if c != "Location"}
    api_text = F.to_json(
        F.struct(
            *[c.alias(name) for name, c in snakes.items()],
            F.when(F.col("Latitude").isNotNull(), place).alias("location"),
        )
    )
    # flags as JSON booleans where the text is one
    api_text = F.regexp_replace(api_text, '(?i)("arrest":)"(true|false)"', "$1$2")
    api_text = F.regexp_replace(api_text, '"arrest":TRUE', '"arrest":true')
    value = (
        F.when(event % 89 == 1, "not json")
        .when(event % 83 == 2, "")
        .when(event % 2 == 0, api_text)
        .otherwise(titles)
    )
    return raw.select(F.col("Description").alias("kind"), F.col("ID").alias("key"), value.alias("value"))


def derived_predictions(processed: DataFrame) -> DataFrame:
    """Stand-ins for stored predictions, computed from each incident's ID."""
    number = F.col("ID").cast("bigint")
    score = (number * 37 % 101) / F.lit(100.0)
    return processed.select(
        "ID",
        "crime_category",
        "is_domestic_incident",
        score.alias("prob_domestic"),
        (score >= 0.5).cast("double").alias("predicted_is_domestic"),
        F.expr(_nth(CRIME_CLASSES, "cast(ID as bigint) % 5")).alias("predicted_crime_category"),
    )
