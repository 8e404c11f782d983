"""Reports on stored predictions and training runs."""

from pyspark.sql import DataFrame, Window, functions as F

from beatline.functions.sampling import key_fraction
from beatline.operators.clean import require_columns
from beatline.session import Staging

BINS = 50
TOP_FEATURES = 15
METRICS = ["accuracy", "f1", "auc"]


def class_distribution(predictions: DataFrame, truth: str, predicted: str) -> DataFrame:
    """How often each class is true and how often predicted, 0 where it is not, in one pass."""
    pairs = predictions.groupBy(truth, predicted).agg(F.count("*").alias("n"))
    sides = F.array(
        F.struct(F.col(truth).alias("label"), F.col("n").alias("true_n"), F.lit(0).cast("bigint").alias("pred_n")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).cast("bigint").alias("true_n"), F.col("n").alias("pred_n")),
    )
    return (
        pairs.select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("true_n").alias("true_count"), F.sum("pred_n").alias("pred_count"))
        .orderBy("label")
    )


def confusion_counts(predictions: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows per pair of true and predicted class, rows without either left out."""
    return (
        predictions.select(F.col(truth).alias("label"), F.col(predicted).alias("prediction"))
        .transform(require_columns, ["label", "prediction"])
        .groupBy("label", "prediction")
        .agg(F.count("*").alias("n"))
    )


def confusion_matrix(counts: DataFrame, classes: list) -> DataFrame:
    """One row per true class, one column per predicted class, in the order given; empty cells are 0.

    A class that is not given fails the query, as it would lose its rows.
    """
    known = F.col("label").isin(classes) & F.col("prediction").isin(classes)
    pair = F.concat_ws(" as ", F.col("label").cast("string"), F.col("prediction").cast("string"))
    checked = F.when(known, F.col("n")).otherwise(
        F.raise_error(F.concat(F.lit("class outside the given ones: "), pair)).cast("bigint")
    )
    cells = [
        F.coalesce(F.sum(F.when(F.col("prediction") == F.lit(c), F.col("n"))), F.lit(0).cast("bigint")).alias(f"c{i}")
        for i, c in enumerate(classes)
    ]
    return (
        counts.withColumn("n", checked)
        .groupBy("label")
        .agg(*cells)
        .orderBy(F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")))
        .toDF("label", *[f"pred_{i}" for i in range(len(classes))])
    )


def quality_scores(counts: DataFrame) -> DataFrame:
    """Accuracy and class-weighted F1 from confusion counts: one row."""
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("truth"), F.lit(0).cast("bigint").alias("pred")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("truth"), F.col("n").alias("pred")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    per_class = (
        counts.select(F.inline(sides), hit.alias("hits"))
        .groupBy("class")
        .agg(
            F.sum("truth").alias("truth"),
            F.sum("pred").alias("pred"),
            # a hit is listed on both sides of its pair
            (F.sum("hits") / 2).alias("hits"),
        )
    )
    f1 = 2 * F.col("hits") / (F.col("truth") + F.col("pred"))
    return per_class.agg(
        (F.sum("hits") / F.sum("truth")).alias("accuracy"),
        (F.sum(F.col("truth") * f1) / F.sum("truth")).alias("f1"),
    )


def area_under_roc(predictions: DataFrame, label: str, score: str) -> float:
    """The share of (positive, negative) pairs that the score puts in order, ties half: exact at any number of scores.

    Rows are counted per score first.  The scores are then dealt over tasks by range, so that the negatives below a score are
    those of all ranges before its own, one number per range, and those below it in its range.  0 where a class is absent.
    """
    staging = Staging(predictions.sparkSession)
    known = predictions.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
    counted = known.dropna().groupBy("score").agg(
        F.count_if(F.col("label") > 0.5).alias("positives"), F.count_if(F.col("label") <= 0.5).alias("negatives")
    )
    # written, so that the ranges stay as they are when a task is repeated
    ranges = staging.write(
        counted.repartitionByRange("score").withColumn("range", F.spark_partition_id()), "score-ranges"
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("range").agg(F.sum("negatives").alias("n"))
    begins = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    below = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.withColumn("below", F.coalesce(F.sum("negatives").over(below), F.lit(0))).join(begins, "range")
    won = F.col("positives") * (F.col("begin") + F.col("below") + F.col("negatives") / 2)
    sums = placed.agg(F.sum(won), F.sum("positives").cast("double"), F.sum("negatives").cast("double")).first()
    staging.drop("score-ranges")
    return sums[0] / (sums[1] * sums[2]) if sums[1] and sums[2] else 0.0


def probability_histogram(predictions: DataFrame, column: str = "prob_domestic", bins: int = BINS) -> DataFrame:
    """Rows in each of the equal bins between the least and the greatest value, over all rows.

    Bins hold their lower edge, the last also its upper; empty bins have no row.  The range takes a pass of
    its own: probabilities hardly repeat, so counting each value first would shuffle the whole table.
    """
    values = predictions.select(F.col(column).cast("double").alias("p")).transform(require_columns, ["p"])
    bounds = values.agg(F.struct(F.min("p").alias("low"), F.max("p").alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    place = F.coalesce(F.try_divide(F.col("p") - low, high - low), F.lit(0.0))
    number = F.least(F.floor(place * bins), F.lit(bins - 1)).cast("int")
    return values.groupBy(number.alias("bin")).agg(F.count("*").alias("n"))


def sample_probabilities(
    predictions: DataFrame, column: str = "prob_domestic", fraction: float = 0.01, seed: int = 42
) -> DataFrame:
    """A fixed share of the probabilities, for a plot of single values."""
    return predictions.filter(key_fraction(F.col("ID"), seed) < fraction).select(
        F.col(column).cast("double").alias("prob")
    ).transform(require_columns, ["prob"])


def metric_comparison(runs: DataFrame) -> DataFrame:
    """Metrics of each task's newest run, one row per metric; NULL where a run lacks it."""
    # runs of one moment are told apart by their metrics, so the choice repeats
    order = F.struct(F.col("created_at").try_cast("timestamp"), "created_at", "metrics")
    newest = runs.groupBy("task_type").agg(F.max_by("metrics", order).alias("m"))
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"m.{name}").alias("score")) for name in METRICS])
    return newest.select("task_type", F.inline(pairs))


def top_features(runs: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """Most important features of the given run."""
    return (
        runs.select(F.inline("feature_importance"))
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )
