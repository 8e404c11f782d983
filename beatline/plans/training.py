"""Train a task's model, score its test rows and describe the run."""

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from beatline import schema
from beatline.operators import learning, model_reports
from beatline.operators.learning import Task
from beatline.session import staged, staging_path


@dataclass(frozen=True)
class Training:
    model: PipelineModel
    labels: list[str]
    predictions: DataFrame
    run: DataFrame
    dropped_features: list[str]


def _saved(model: PipelineModel, spark: SparkSession, name: str) -> PipelineModel:
    """The model as stored: without the training summary, whose session reference cannot go to executors
    once the session has observed metrics."""
    path = staging_path(spark, name)
    model.save(path)
    return PipelineModel.load(path)


def prepare(processed: DataFrame, task: Task, fraction: float = learning.SAMPLE_FRACTION) -> DataFrame:
    """Sampled feature frame with collapsed locations and the training mark.

    The sample is written once with its marks, since it is read for the top locations and by every pass of the training.
    The top locations, twenty at most, come to the driver and return as constants.
    """
    sampled = learning.sample(learning.feature_frame(processed, task), fraction)
    texts = [c for c in learning.CATEGORICAL if c in sampled.columns]
    used = dict.fromkeys([*learning.CONTEXT, *task.numeric, *texts, task.target])
    frame = staged(learning.split(sampled.select(*used)), f"{task.name}-frame")
    kept = [row["Location Description"] for row in learning.top_locations(frame).collect()]
    return learning.collapse_locations(frame, kept)


def usable_categories(frame: DataFrame) -> list[str]:
    """Text features whose values, with one more for unseen text, fit the forest's bins."""
    counts = learning.cardinality(frame, list(learning.CATEGORICAL)).first()
    return [c for c in learning.CATEGORICAL if counts[c] < learning.MAX_BINS]


def _framed(processed: DataFrame, task: Task, fraction: float) -> DataFrame:
    """The prepared frame with the label where the task's target is a number itself."""
    frame = prepare(processed, task, fraction)
    return frame if task.classes is None else frame.withColumn("label", F.col(task.target).cast("double"))


def test_rows(processed: DataFrame, task: Task, fraction: float = learning.SAMPLE_FRACTION) -> DataFrame:
    """The rows that ``train`` scores, with their context and truth.

    They depend on sample, split and encoding, all as in the training; no forest is fitted.
    """
    frame = _framed(processed, task, fraction)
    encoder = Pipeline(stages=learning.encoding(task, usable_categories(frame)))
    encoded = encoder.fit(frame.filter("is_train")).transform(frame.filter(~F.col("is_train")))
    return encoded.select(*learning.CONTEXT, task.target)


def train(
    processed: DataFrame,
    task: Task,
    fraction: float = learning.SAMPLE_FRACTION,
    forest: dict | None = None,
) -> Training:
    """Fit on the training rows and score the others; the run names the text features with too many values.

    The sample, the model and the scored rows are each written once; fitting, counts and metrics read them.
    """
    spark = processed.sparkSession
    frame = _framed(processed, task, fraction)
    usable = usable_categories(frame)
    dropped = [c for c in learning.CATEGORICAL if c not in usable]
    fitted = learning.pipeline(task, usable, forest).fit(frame.filter("is_train"))
    model = _saved(fitted, spark, f"{task.name}-model")
    labels = learning.class_labels(model, task)

    *encoders, forest_model = fitted.stages
    encoded = PipelineModel(encoders).transform(frame.filter(~F.col("is_train")))
    importances = learning.feature_importances(model, encoded)
    scored = forest_model.grown.transform(encoded)
    named = learning.name_predictions(scored, task, labels).select(
        *learning.CONTEXT, *task.outputs, "label", "prediction", vector_to_array("probability").alias("prob_array")
    )
    scored = staged(named, f"{task.name}-scored")

    scores = model_reports.quality_scores(
        model_reports.confusion_counts(scored, "label", "prediction")
    ).first()
    auc = None
    if task.classes is not None:
        auc = model_reports.area_under_roc(scored, "label", "prob_domestic")
    counts = {row["is_train"]: row["count"] for row in frame.groupBy("is_train").count().collect()}
    run = spark.createDataFrame(
        [
            (
                "RandomForestClassifier",
                task.name,
                task.target,
                labels,
                datetime.now(timezone.utc).replace(tzinfo=None).isoformat(),
                (scores["accuracy"], scores["f1"], auc),
                counts.get(True, 0),
                counts.get(False, 0),
                importances,
                fraction,
                dropped,
            )
        ],
        schema.RUN_SCHEMA,
    )
    return Training(model, labels, scored, run, dropped)


def prediction_table(training: Training, task: Task) -> DataFrame:
    """The stored predictions; ``prob_array`` repeats the probabilities for readers without vectors."""
    return training.predictions.select(*learning.CONTEXT, *task.outputs, "prob_array")


def scored_sample(training: Training, task: Task, rows: int = 20) -> DataFrame:
    """A few scored rows to look at."""
    shown = ["crime_datetime", "District", "location_category", "crime_hour", "crime_day_of_week", "crime_month"]
    if task.classes is None:
        return candidate_table(training).select(
            *shown, "crime_category", "predicted_crime_category", "top3_candidates"
        ).limit(rows)
    return training.predictions.select(
        *shown,
        "Location Description",
        "is_domestic_incident",
        "predicted_is_domestic",
        "predicted_domestic_str",
        "prob_domestic",
    ).limit(rows)


def candidate_table(training: Training) -> DataFrame:
    """Predictions with the three likeliest classes."""
    return training.predictions.withColumn(
        "top3_candidates", learning.top_candidates(F.col("prob_array"), training.labels)
    )
