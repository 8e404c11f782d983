"""Training on a small table, and reports against scikit-free plain Python."""

from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from beatline.operators import learning, model_reports
from beatline.operators.forest import Forest, _thresholds, draws
from beatline.plans import etl, training
from beatline.sinks.tables import append_run
from beatline.sources import runs
from workload import derive

SMALL = {**learning.FOREST, "numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 1}


@pytest.fixture(scope="module")
def processed(spark, sf_dir):
    return etl.process(derive.raw_incidents(spark, sf_dir).drop("event_id"))


@pytest.fixture(scope="module", params=[learning.CRIME_TYPE, learning.DOMESTIC], ids=lambda t: t.name)
def trained(request, processed):
    return request.param, training.train(processed, request.param, forest=SMALL)


def test_training(spark, trained, tmp_path):
    task, result = trained
    table = training.prediction_table(result, task)
    assert table.columns == learning.CONTEXT + task.outputs + ["prob_array"]
    rows = table.collect()
    assert rows and all(sum(r["prob_array"]) == pytest.approx(1) for r in rows)
    run = result.run.first()
    assert run["test_records"] == len(rows) and run["training_records"] > 2 * len(rows)
    assert sum(f["importance"] for f in run["feature_importance"]) == pytest.approx(1)
    weights = [f["importance"] for f in run["feature_importance"]]
    assert weights == sorted(weights, reverse=True)
    if task is learning.DOMESTIC:
        assert run["label_classes"] == ["Non-Domestic", "Domestic"] and 0 <= run["metrics"]["auc"] <= 1
        assert all(r["prob_domestic"] == r["prob_array"][1] for r in rows)
        assert all((r["predicted_domestic_str"] == "Domestic") == (r["predicted_is_domestic"] == 1.0) for r in rows)
    else:
        assert run["metrics"]["auc"] is None
        best = [max(range(len(result.labels)), key=lambda i: r["prob_array"][i]) for r in rows]
        assert all(r["predicted_crime_category"] == result.labels[i] for r, i in zip(rows, best))
        first = training.candidate_table(result).first()
        assert first["top3_candidates"][0].startswith(first["predicted_crime_category"] + ":")

    for _ in range(2):
        append_run(result.run, f"{tmp_path}/runs")
    assert runs.latest_runs(runs.read_runs(spark, f"{tmp_path}/runs"), task.name).count() == 2


def test_scores_are_those_of_the_evaluators(trained):
    _, result = trained
    metrics = result.run.first()["metrics"]
    for name in ("accuracy", "f1"):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert metrics[name] == pytest.approx(evaluator.evaluate(result.predictions))


def test_sample_and_split_repeat(processed):
    frame = learning.feature_frame(processed, learning.CRIME_TYPE)
    draw = lambda df: sorted(learning.split(learning.sample(df)).select("ID", "is_train").collect())
    assert draw(frame) == draw(frame.repartition(11, "season"))


def test_weekend_days_are_a_parameter(processed):
    days = lambda **kw: {
        r[0] for r in learning.feature_frame(processed, learning.DOMESTIC, **kw)
        .filter("is_weekend = 1").select("crime_day_of_week").distinct().collect()
    }
    assert days() == {6} and days(weekend_days=(1, 7)) == {1, 7}


def test_cardinality_counts_null_as_a_value(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", None), (None, None), ("a", "x")], "p string, q string")
    assert tuple(learning.cardinality(rows, ["p", "q"]).first()) == (3, 2)


def test_collapse(spark):
    rows = spark.createDataFrame([("A",), ("B",), (None,)], "`Location Description` string")
    collapsed = learning.collapse_locations(rows, ["A", None])
    assert sorted(r["loc_desc_topN"] for r in collapsed.collect()) == ["A", "OTHER", "OTHER"]


@pytest.mark.parametrize(
    "probabilities", [[0.2, 0.5, 0.2, 0.1, 0.0], [0.0625, 0.0625, 0.8125, 0.0625, 0.0], [1.0, 0.0, 0.0, 0.0, 0.0]]
)
def test_top_candidates_like_python(spark, probabilities):
    labels = list("abcde")
    ranked = sorted(enumerate(probabilities), key=lambda pair: pair[1], reverse=True)[:3]
    column = F.array(*[F.lit(p) for p in probabilities])
    found = spark.range(1).select(learning.top_candidates(column, labels).alias("t")).first()["t"]
    assert found == [f"{labels[i]}:{p:.3f}" for i, p in ranked]


PAIRS = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), (None, "a"), ("a", None), ("a", "d")]


def test_confusion_and_distribution(spark):
    rows = spark.createDataFrame(PAIRS, "t string, p string")
    counts = model_reports.confusion_counts(rows, "t", "p")
    expected = Counter(pair for pair in PAIRS if None not in pair)
    assert {(r["label"], r["prediction"]): r["n"] for r in counts.collect()} == expected
    classes = list("abcd")
    matrix = {r["label"]: list(r)[1:] for r in model_reports.confusion_matrix(counts, classes).collect()}
    assert matrix == {t: [expected[(t, p)] for p in classes] for t in "abc"}
    both = {r["label"]: (r["true_count"], r["pred_count"]) for r in model_reports.class_distribution(rows, "t", "p").collect()}
    truth, predicted = Counter(t for t, _ in PAIRS), Counter(p for _, p in PAIRS)
    assert both == {label: (truth[label], predicted[label]) for label in {*truth, *predicted}}


def test_area_under_roc_counts_ordered_pairs(spark):
    scored = [(float(i % 3 == 0), round((i * 37 % 101) / 10) / 10) for i in range(200)]
    rows = spark.createDataFrame(scored, "label double, p double")
    ones, zeros = ([p for label, p in scored if label == k] for k in (1.0, 0.0))
    wins = sum((a > b) + (a == b) / 2 for a, b in product(ones, zeros))
    assert model_reports.area_under_roc(rows, "label", "p") == pytest.approx(wins / len(ones) / len(zeros))


def test_histogram(spark):
    rows = spark.createDataFrame([(i / 100,) for i in range(101)] + [(None,)], "prob_domestic double")
    bins = {r["bin"]: r["n"] for r in model_reports.probability_histogram(rows).collect()}
    assert sum(bins.values()) == 101 and set(bins) == set(range(50)) and bins[49] == 3
    same = spark.createDataFrame([(0.5,), (0.5,)], "prob_domestic double")
    assert [tuple(r) for r in model_reports.probability_histogram(same).collect()] == [(0, 2)]


def test_scored_sample(trained):
    task, result = trained
    shown = training.scored_sample(result, task, rows=5)
    assert shown.count() == 5 and "ID" not in shown.columns


def test_class_outside_the_list_fails(spark):
    counts = spark.createDataFrame([(0.0, 0.0, 5), (0.0, 2.0, 7)], "label double, prediction double, n bigint")
    with pytest.raises(Exception, match="outside the given"):
        model_reports.confusion_matrix(counts, [0.0, 1.0]).collect()


def test_area_under_roc_is_exact_beyond_a_thousand_scores(spark):
    from random import Random

    draw = Random(1)
    scores = [(float(draw.random() < p), p) for p in (i / 6000 for i in range(6000))]
    walked, negatives, wins = 0, 0, 0.0
    for label, _ in sorted(scores, key=lambda x: -x[1]):
        if label:
            walked += 1
        else:
            negatives += 1
            wins += walked
    frame = spark.createDataFrame(scores, "label double, p double")
    assert model_reports.area_under_roc(frame, "label", "p") == pytest.approx(wins / walked / negatives, abs=1e-12)


def test_test_rows_are_those_that_are_scored(trained, processed):
    task, result = trained
    columns = [*learning.CONTEXT, task.target]
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    found = rows(training.test_rows(processed, task))
    assert found and found == rows(training.prediction_table(result, task))


def test_test_rows_need_no_forest(processed, monkeypatch):
    monkeypatch.setattr(training.learning, "pipeline", lambda *args: pytest.fail("fits a forest"))
    assert training.test_rows(processed, learning.CRIME_TYPE).count() > 0


def test_query_of_test_rows_trains_nothing(spark, sf_dir, monkeypatch):
    from workload import catalog

    monkeypatch.setattr(catalog, "_trained", lambda *args: pytest.fail("fits a forest"))
    assert catalog.queries()["ml_test_rows"](spark, sf_dir).count() > 0


@pytest.mark.parametrize("classes", [2, 3])
def test_forest_without_draws_is_the_tree_of_mllib(spark, classes):
    rows = spark.range(3000).selectExpr(
        "id as ID",
        f"double((id * 7 + int(id % 13 > 5) * int(id / 50) + int(id % 37 / 5)) % {classes}) as label",
        "double(id % 37) / 4 as a",
        "double(int(id / 50)) as b",
        "string(id % 5) as c",
        "string(id * id % 11) as d",
        "1.0D as same",
    )
    stages = [
        StringIndexer(inputCols=["c", "d"], outputCols=["ci", "di"], handleInvalid="keep"),
        VectorAssembler(inputCols=["a", "b", "ci", "di", "same"], outputCol="features"),
    ]
    encoded = Pipeline(stages=stages).fit(rows).transform(rows)
    settings = {"maxDepth": 6, "maxBins": 64, "minInstancesPerNode": 20}
    tree = DecisionTreeClassifier(**settings).fit(encoded)
    grown = Forest("ID", classes, numTrees=1, featureSubsetStrategy="all", bootstrap=False, **settings).fit(encoded)
    assert grown.trees[0].numNodes == tree.numNodes > 20
    assert list(grown.featureImportances) == pytest.approx(list(tree.featureImportances))
    read = lambda model: [tuple(r["probability"]) for r in model.transform(encoded).orderBy("ID").collect()]
    assert read(grown) == [pytest.approx(p) for p in read(tree)]


def test_forest_draws_by_key_and_not_by_layout(spark):
    rows = spark.range(2000).selectExpr("id as ID", "double((id * 7 + int(id / 90)) % 3) as label", "double(id % 97) as a", "double(id % 89) as b")
    encoded = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    grow = lambda df: Forest("ID", 3, numTrees=3, maxDepth=4, subsamplingRate=0.7).fit(df).toDebugString.split("\n", 1)[1]
    assert grow(encoded) == grow(encoded.repartition(5, "a"))


def test_draws_are_of_the_poisson_distribution():
    keys = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ** np.uint64(2)
    drawn = [draws(keys, tree, 42, _thresholds(0.7)) for tree in range(3)]
    for rows, weight in drawn:
        for k, share in enumerate([0.3476, 0.1217, 0.0284], start=1):
            assert (weight == k).sum() / len(keys) == pytest.approx(share, abs=0.005)
    both = len(np.intersect1d(drawn[0][0], drawn[1][0])) / len(keys)
    assert both == pytest.approx(0.5034**2, abs=0.005)


def test_forest_is_as_good_as_that_of_mllib(trained, processed):
    task, result = trained
    frame = training._framed(processed, task, learning.SAMPLE_FRACTION)
    encoder = Pipeline(stages=learning.encoding(task, training.usable_categories(frame))).fit(frame.filter("is_train"))
    taught, held = (encoder.transform(frame.filter(side)) for side in ("is_train", "not is_train"))
    other = RandomForestClassifier(**SMALL).fit(taught)
    accuracy = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    ours, theirs = accuracy.evaluate(result.predictions), accuracy.evaluate(other.transform(held))
    assert ours == pytest.approx(theirs, abs=0.12)


def test_pipeline_ends_in_the_forest_by_levels():
    assert isinstance(learning.pipeline(learning.CRIME_TYPE, list(learning.CATEGORICAL)).getStages()[-1], Forest)


def test_candidates_wait_for_no_fit_of_mllib(spark, sf_dir, monkeypatch):
    from workload import catalog

    catalog.forget_trainings()
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *args: pytest.fail("trained by MLlib"))
    rows = catalog.queries()["ml_candidates"](spark, sf_dir).collect()
    assert rows and all(r["top3_candidates"][0].startswith(r["predicted_crime_category"] + ":") for r in rows)


def _many_sided(spark, rows=4000):
    numbers = spark.range(rows).selectExpr(
        "id as ID",
        "double((id * 7 + int(id % 13 > 5) * int(id / 50) + int(id % 37 / 5)) % 3) as label",
        "double(id % 37) / 4 as a",
        "double(id * 31 % 997) / 3 as b",
        "string(id % 5) as c",
        "string(id * id % 11) as d",
    )
    stages = [
        StringIndexer(inputCols=["c", "d"], outputCols=["ci", "di"], handleInvalid="keep"),
        VectorAssembler(inputCols=["a", "b", "ci", "di"], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(numbers.filter("c != '3'")).transform(numbers)


@pytest.mark.parametrize("settings", [{"maxDepth": 7, "minInstancesPerNode": 5}, {"maxDepth": 1}, {"maxDepth": 3, "minInstancesPerNode": 2000}])
def test_scores_are_the_doubles_of_mllib(spark, settings):
    encoded = _many_sided(spark)
    model = Forest("ID", 3, numTrees=7, maxBins=64, subsamplingRate=0.7, **settings).fit(encoded.filter("c != '3'"))
    read = lambda df: [(tuple(r[0]), r[1]) for r in df.orderBy("ID").select("probability", "prediction").collect()]
    assert read(model.grown.transform(encoded)) == read(model.transform(encoded))


def test_training_scores_without_mllib(processed, monkeypatch):
    monkeypatch.setattr(RandomForestClassificationModel, "_transform", lambda *args: pytest.fail("scored row by row by MLlib"))
    assert training.train(processed, learning.CRIME_TYPE, forest=SMALL).predictions.count() > 0


def test_forest_encodes_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = _many_sided(spark, 1500).drop("features").withColumn("b", counted("b"))
    encoded = VectorAssembler(inputCols=["a", "b", "ci", "di"], outputCol="features").transform(rows)
    Forest("ID", 3, numTrees=2, maxDepth=2, maxBins=64).fit(encoded)
    assert seen.value == 1500
