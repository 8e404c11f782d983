"""Column names and types of the incident tables."""

from pyspark.sql import types as T

# The raw table's columns, all nullable strings.
RAW_COLUMNS = [
    "ID",
    "Case Number",
    "Date",
    "Block",
    "IUCR",
    "Primary Type",
    "Description",
    "Location Description",
    "Arrest",
    "Domestic",
    "Beat",
    "District",
    "Ward",
    "Community Area",
    "FBI Code",
    "X Coordinate",
    "Y Coordinate",
    "Year",
    "Updated On",
    "Latitude",
    "Longitude",
    "Location",
]

# The processed table's columns, base columns first, then features.
PROCESSED_COLUMNS = [
    "ID",
    "Case Number",
    "Date",
    "Primary Type",
    "Description",
    "Location Description",
    "Arrest",
    "Domestic",
    "Beat",
    "District",
    "Ward",
    "Community Area",
    "Year",
    "Latitude",
    "Longitude",
    "crime_datetime",
    "crime_year",
    "crime_month",
    "crime_day",
    "crime_hour",
    "crime_day_of_week",
    "time_of_day",
    "season",
    "location_category",
    "location_risk_weight",
    "crime_category",
    "crime_severity_level",
    "crime_severity_weight",
    "is_violent",
    "is_night",
    "was_arrest_made",
    "is_domestic_incident",
    "is_public_space",
    "risk_score",
]

REQUIRED_COLUMNS = ["ID", "Date", "Primary Type", "Year"]
INT_COLUMNS = ["Beat", "District", "Ward", "Community Area", "Year"]
DOUBLE_COLUMNS = ["X Coordinate", "Y Coordinate", "Latitude", "Longitude"]
FLAG_COLUMNS = ["Arrest", "Domestic"]

PLACE_STRUCT = T.StructType(
    [T.StructField("latitude", T.StringType()), T.StructField("longitude", T.StringType())]
)


def snake_name(title: str) -> str:
    """API spelling of a raw column: ``Case Number`` -> ``case_number``."""
    return title.lower().replace(" ", "_")


def raw_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def api_schema() -> T.StructType:
    """API message layout: snake_case strings and a nested location."""
    fields = [T.StructField(snake_name(c), T.StringType()) for c in RAW_COLUMNS if c != "Location"]
    return T.StructType(fields + [T.StructField("location", PLACE_STRUCT)])


CURSOR_SCHEMA = T.StructType(
    [
        T.StructField("last_updated_on", T.StringType()),
        T.StructField("last_id", T.StringType()),
        T.StructField("last_missing", T.BooleanType()),
        T.StructField("saved_at", T.TimestampType()),
        T.StructField("sequence", T.LongType()),
    ]
)

IMPORTANCE_TYPE = T.ArrayType(
    T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("label_col", T.StringType()),
        T.StructField("label_classes", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.StringType()),
        T.StructField(
            "metrics",
            T.StructType(
                [
                    T.StructField("accuracy", T.DoubleType()),
                    T.StructField("f1", T.DoubleType()),
                    T.StructField("auc", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("training_records", T.LongType()),
        T.StructField("test_records", T.LongType()),
        T.StructField("feature_importance", IMPORTANCE_TYPE),
        T.StructField("sample_fraction", T.DoubleType()),
        T.StructField("dropped_features", T.ArrayType(T.StringType())),
    ]
)
