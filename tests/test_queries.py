"""Every registered query against its SQL twin, and the shape of the plans."""

import re

import pytest

from workload import catalog, oracle
from workload.check import connect, differences

ROWS_ONLY = {
    "ml_crime_type_predictions",
    "ml_domestic_predictions",
    "ml_candidates",
    "ml_run_document",
    "feature_importance",
}
# joins by comparison, rows through Python, and cut lineage have no place in a plan
FORBIDDEN = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups"
)


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module", autouse=True)
def own_trainings():
    yield
    catalog.forget_trainings()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_agrees_with_sql(spark, db, sf_dir, name):
    assert differences(spark, db, name, sf_dir) == []


def test_all_but_trained_results_have_sql():
    assert set(catalog.queries()) - set(oracle.statements()) == ROWS_ONLY
    assert set(oracle.statements()) <= set(catalog.queries())


@pytest.mark.parametrize(
    "name",
    [
        "clean_incidents",
        "risk_score",
        "arrest_rate_top20",
        "night_risk_quadrants",
        "weekday_hour_matrix",
        "choropleth_classes",
        "incremental_load",
        "keyset_page",
        "ml_feature_frame",
        "class_distribution",
        "top3_candidates",
    ],
)
def test_plan_is_native(spark, sf_dir, name):
    plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not FORBIDDEN.search(plan)


def test_narrow_query_reads_few_columns(spark, sf_dir):
    plan = catalog.queries()["yearly_trend"](spark, sf_dir)._jdf.queryExecution().toString()
    # all that makes up a raw record, as the choice among its copies may depend on it, but no other column
    expected = "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>"
    assert re.findall(r"ReadSchema: (\S+)", plan) == [expected]


def test_entry_runs(spark):
    import __spark_entry__ as contract

    years = {row["Year"] for row in contract.entry(spark).collect()}
    assert years == {2024, 2025, 2026}
    assert set(contract.oracle_sql()) <= set(contract.queries())
