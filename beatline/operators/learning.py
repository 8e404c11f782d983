"""Feature frames, encoding and scoring of the two random-forest tasks."""

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from beatline.functions.sampling import key_fraction
from beatline.operators.clean import require_columns
from beatline.operators.forest import Forest

# Settings of sampling, encoding and forest.
SAMPLE_FRACTION = 0.7
TRAIN_FRACTION = 0.8
SEED = 42
TOP_LOCATIONS = 20
OTHER_LOCATION = "OTHER"
MAX_BINS = 64
FOREST = {
    "numTrees": 60,
    "maxDepth": 10,
    "maxBins": MAX_BINS,
    "featureSubsetStrategy": "sqrt",
    "subsamplingRate": 0.7,
    "minInstancesPerNode": 30,
    "seed": SEED,
}

# Text features, each with the name of its index.
CATEGORICAL = {
    "time_of_day": "time_of_day_idx",
    "season": "season_idx",
    "location_category": "location_category_idx",
    "District_str": "District_idx",
    "loc_desc_topN": "loc_desc_idx",
}

# Context columns kept with every prediction.
CONTEXT = [
    "ID",
    "crime_datetime",
    "District",
    "Community_Area",
    "Location Description",
    "location_category",
    "crime_hour",
    "crime_day_of_week",
    "crime_month",
    "time_of_day",
    "season",
]


@dataclass(frozen=True)
class Task:
    """What one of the two models predicts, and from what."""

    name: str
    target: str
    numeric: list[str]
    flags: list[str]
    outputs: list[str]
    classes: list[str] | None = None
    required: list[str] = field(
        default_factory=lambda: [
            "crime_hour",
            "crime_day_of_week",
            "crime_month",
            "District",
            "location_category",
        ]
    )


# Features and outputs of the two tasks.
CRIME_TYPE = Task(
    name="crime_type_prediction",
    target="crime_category",
    numeric=[
        "crime_hour",
        "location_risk_weight",
        "Latitude",
        "Longitude",
        "Community_Area",
        "is_domestic_incident",
        "is_public_space",
        "is_weekend",
    ],
    flags=["is_night", "is_domestic_incident", "is_public_space"],
    outputs=["crime_category", "predicted_crime_category", "probability"],
)
DOMESTIC = Task(
    name="domestic_incident_prediction",
    target="is_domestic_incident",
    numeric=[
        "crime_hour",
        "crime_day_of_week",
        "crime_month",
        "location_risk_weight",
        "Latitude",
        "Longitude",
        "District",
        "Community_Area",
        "is_night",
        "is_public_space",
        "is_weekend",
        "is_work_hour",
    ],
    flags=["is_night", "is_public_space"],
    outputs=[
        "is_domestic_incident",
        "predicted_is_domestic",
        "predicted_domestic_str",
        "probability",
        "prob_domestic",
    ],
    classes=["Non-Domestic", "Domestic"],
)


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def feature_frame(processed: DataFrame, task: Task, weekend_days: tuple[int, ...] = (0, 6)) -> DataFrame:
    """Features of every incident that has the required values; other unknown numbers become 0.

    ``weekend_days`` are the numbers the trained models know as weekend.  Days run from 1 = Sunday, so the
    default marks Fridays only; pass ``(1, 7)`` for Saturday and Sunday.
    """
    stored = [
        "ID",
        "crime_datetime",
        "Location Description",
        "location_category",
        "crime_category",
        "crime_hour",
        "crime_day_of_week",
        "crime_month",
        "time_of_day",
        "season",
        "location_risk_weight",
        "Latitude",
        "Longitude",
        "is_night",
        "is_domestic_incident",
        "is_public_space",
    ]
    district = F.col("District").cast("double")
    return (
        processed.transform(require_columns, [*task.required, task.target])
        .select(
            *stored,
            district.alias("District"),
            F.col("Community Area").cast("double").alias("Community_Area"),
            district.cast("string").alias("District_str"),
            _one_if(F.col("crime_day_of_week").isin(*weekend_days)).alias("is_weekend"),
            _one_if(F.col("crime_hour").between(8, 18)).alias("is_work_hour"),
        )
        .withColumns({flag: F.col(flag).cast("double") for flag in task.flags})
        .na.fill(0.0, subset=task.numeric)
    )


def sample(df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = SEED) -> DataFrame:
    return df.filter(key_fraction(F.col("ID"), seed) < fraction)


def split(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """Mark training rows in ``is_train``; the draw is independent of the one for the sample."""
    return df.withColumn("is_train", key_fraction(F.col("ID"), seed, draw=1) < fraction)


def top_locations(df: DataFrame, top: int = TOP_LOCATIONS) -> DataFrame:
    """The most frequent location texts, NULL possibly one of them; equal counts go by text."""
    return (
        df.groupBy("Location Description")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.col("Location Description").asc_nulls_last())
        .limit(top)
    )


def collapse_locations(df: DataFrame, kept: list[str | None]) -> DataFrame:
    """``loc_desc_topN``: the location text where it is among the few to keep, else OTHER, as for NULL."""
    text = F.col("Location Description")
    return df.withColumn("loc_desc_topN", F.when(text.isin(kept), text).otherwise(OTHER_LOCATION))


def cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column, NULL being one, in one row and one pass over the values.

    Values are first grouped together, so the distinct counts run on their few combinations.
    """
    combinations = df.groupBy(*columns).agg(F.count("*").alias("n"))
    counts = [
        (F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns
    ]
    return combinations.agg(*counts)


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def encoding(task: Task, categorical: list[str]) -> list:
    """Stages from text to indexes and from features to a vector; rows that cannot be encoded are left out."""
    stages = []
    if task.classes is None:
        stages.append(StringIndexer(inputCol=task.target, outputCol="label", handleInvalid="skip"))
    indexes = [CATEGORICAL[c] for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=indexes, handleInvalid="keep"))
    return [*stages, VectorAssembler(inputCols=task.numeric + indexes, outputCol="features", handleInvalid="skip")]


def pipeline(task: Task, categorical: list[str], forest: dict | None = None) -> Pipeline:
    """Text to indexes, features to a vector, and the forest."""
    classes = None if task.classes is None else len(task.classes)
    return Pipeline(stages=[*encoding(task, categorical), Forest("ID", classes, **(forest or FOREST))])


def class_labels(model: PipelineModel, task: Task) -> list[str]:
    first = model.stages[0]
    return list(first.labels) if task.classes is None and isinstance(first, StringIndexerModel) else task.classes


def name_predictions(scored: DataFrame, task: Task, labels: list[str]) -> DataFrame:
    """Readable prediction and, for the two-class task, the probability of the second class."""
    if task.classes is None:
        to_name = IndexToString(inputCol="prediction", outputCol="predicted_crime_category", labels=labels)
        return to_name.transform(scored)
    return scored.withColumns(
        {
            "predicted_is_domestic": F.col("prediction").cast("double"),
            "predicted_domestic_str": F.when(F.col("prediction") == 1.0, labels[1]).otherwise(labels[0]),
            "prob_domestic": F.try_element_at(vector_to_array("probability"), F.lit(2)),
        }
    )


def top_candidates(probabilities: Column, labels: list[str], top: int = 3) -> Column:
    """The likeliest classes as ``label:0.123``, equal ones in class order."""
    names = F.array(*[F.lit(label) for label in labels])
    ranked = F.array_sort(
        F.transform(probabilities, lambda p, i: F.struct((-p).alias("minus_p"), i.alias("i")))
    )
    return F.transform(
        F.slice(ranked, 1, top),
        lambda c: F.concat(
            F.element_at(names, c["i"] + 1), F.lit(":"), F.format_number(F.abs(c["minus_p"]), 3)
        ),
    )


def feature_importances(model: PipelineModel, scored: DataFrame) -> list[tuple[str, float]]:
    """Features the forest used, most important first; one entry per feature of the model."""
    groups = scored.schema["features"].metadata["ml_attr"]["attrs"].values()
    names = {attribute["idx"]: attribute["name"] for group in groups for attribute in group}
    weights = model.stages[-1].featureImportances.toArray()
    used = [(names[i], float(w)) for i, w in enumerate(weights) if w > 0]
    return sorted(used, key=lambda entry: (-entry[1], entry[0]))
