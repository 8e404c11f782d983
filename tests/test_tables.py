"""Cleaning, features, writing and quality on small tables."""

import glob
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beatline import schema
from beatline.operators import clean, features, quality, trends
from beatline.plans import etl, reports
from beatline.sinks import tables as sinks
from beatline.sources import tables as sources


def record(**more):
    base = {
        "ID": "1", "Case Number": "C1", "Date": "2024-01-05T23:00:00", "Primary Type": "BATTERY", "Year": "2024",
        "Location Description": "STREET", "Arrest": "true", "Domestic": "false", "District": "7",
        "Updated On": "2024-01-06T00:00:00.000",
    }
    return {**base, **{k.replace("_", " "): v for k, v in more.items()}}


def test_required_columns_drop_null_but_not_empty(raw):
    rows = raw(record(), record(ID="2", Primary_Type=None), record(ID="3", Primary_Type=""), record(ID="4", Year=None))
    assert sorted(r["ID"] for r in clean.require_columns(rows).collect()) == ["1", "3"]


def test_required_numbers_drop_nan(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "Latitude double")
    assert clean.require_columns(rows, ["Latitude"]).count() == 1


def test_latest_version_wins_whatever_the_order(raw):
    versions = [
        record(Updated_On="2024-01-06T00:00:00.000", Arrest="false"),
        record(Updated_On="01/07/2024 12:00:00 AM", Arrest="true"),
        record(Updated_On=None, Arrest="maybe"),
        record(ID="2", Case_Number="A"),
        record(ID="2", Case_Number="B"),
    ]
    for order in (versions, versions[::-1]):
        latest = {r["ID"]: r for r in clean.latest_per_id(raw(*order)).collect()}
        assert set(latest) == {"1", "2"}
        assert latest["1"]["Arrest"] == "true" and latest["2"]["Case Number"] == "B"


def test_hot_id_shrinks_before_the_shuffle(raw):
    rows = raw(*[record(Case_Number=f"C{i:05d}") for i in range(3000)], record(ID="2"))
    latest = clean.latest_per_id(rows.repartition(8))
    assert {r["ID"]: r["Case Number"] for r in latest.collect()} == {"1": "C02999", "2": "C1"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(ID")
    assert "WindowGroupLimit" in plan[exchange:]


def test_id_vanishes_when_its_latest_row_has_no_date(raw):
    rows = raw(record(), record(Updated_On="2024-02-01T00:00:00.000", Date="n/a"))
    assert etl.process(rows).count() == 0


def test_types_and_missing_columns(raw):
    typed = clean.type_columns(raw(record(District="7.0", Arrest="TRUE", Domestic="yes")))
    row = typed.first()
    assert (row["District"], row["Arrest"], row["Domestic"], row["Beat"]) == (7, True, None, None)
    kinds = dict(typed.dtypes)
    assert kinds["Year"] == "int" and kinds["Latitude"] == "double" and kinds["Arrest"] == "boolean"

    processed = etl.process(raw(record()).drop("Arrest", "Domestic", "Beat", "Latitude"))
    assert "Beat" not in processed.columns and "Arrest" not in processed.columns
    row = processed.first()
    assert (row["was_arrest_made"], row["is_domestic_incident"]) == (False, False)


def test_processed_schema_and_values(raw):
    processed = etl.process(raw(record(Year="1999", Domestic=None)))
    assert processed.columns == schema.PROCESSED_COLUMNS and len(processed.columns) == 34
    row = processed.first()
    assert row["crime_datetime"] == datetime(2024, 1, 5, 23)
    assert (row["Year"], row["crime_year"], row["crime_day_of_week"], row["season"]) == (2024, 2024, 6, "WINTER")
    assert (row["time_of_day"], row["is_night"], row["is_public_space"]) == ("NIGHT", True, True)
    assert row["is_domestic_incident"] is None and row["risk_score"] == 5.064516129032258


def test_etl_job_counts_and_partitions(spark, raw, tmp_path):
    days = ["2023-05-01T10:00:00", "2024-05-01T10:00:00", "05/01/2024 10:00:00 AM", "bad"]
    raw(*[record(ID=str(i), Date=days[i % 4]) for i in range(400)], record(ID="0", Date=days[0])).write.parquet(f"{tmp_path}/raw")
    counts = etl.run_etl(spark, f"{tmp_path}/raw", f"{tmp_path}/processed")
    assert counts == {"raw_rows": 401, "processed_rows": 300}
    assert {p.split("=")[-1] for p in glob.glob(f"{tmp_path}/processed/Year=*")} == {"2023", "2024"}
    table = sources.read_processed(spark, f"{tmp_path}/processed", years=[2024])
    assert table.count() == 200
    assert re.search(r"PartitionFilters: \[.*Year", table._jdf.queryExecution().toString())


def test_rows_per_file(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit(2024).alias("Year"))
    sinks.write_processed(rows, f"{tmp_path}/t", rows_per_file=300)
    files = glob.glob(f"{tmp_path}/t/Year=2024/*.parquet")
    assert len(files) >= 4
    assert max(spark.read.parquet(f).count() for f in files) <= 300


def test_results_are_replaced(spark, raw, tmp_path):
    first = etl.process(raw(record(), record(ID="2")))
    second = etl.process(raw(record(Date="2020-01-01T00:00:00")))
    for table in (first, second):
        reports.publish_results(table, str(tmp_path))
    assert [tuple(r) for r in sources.read_result(spark, f"{tmp_path}/crime_by_year").collect()] == [(2020, 1)]
    assert sources.read_result(spark, f"{tmp_path}/arrest_rates").first()["arrest_rate"] == 100.0


def test_rates_treat_unknown_arrests_apart(raw):
    processed = etl.process(
        raw(record(), record(ID="2", Arrest=None), record(ID="3", Arrest="false"), record(ID="4", District=None))
    )
    by_type = trends.arrest_rate_by_type(processed).first()
    assert (by_type["total_crimes"], by_type["arrests"], by_type["arrest_rate"]) == (4, 2, 50.0)
    stats = {r["District"]: r for r in trends.district_stats(processed).collect()}
    assert stats[7]["arrest_rate"] == pytest.approx(1 / 3) and stats[None]["crime_count"] == 1
    risk = {r["District"]: r for r in trends.night_risk_by_district(processed).collect()}
    assert set(risk) == {7} and risk[7]["arrest_rate"] == 0.5 and risk[7]["night_crime_ratio"] == 1.0


def test_weekday_matrix_is_complete(raw):
    processed = etl.process(raw(*[record(ID=str(i), Date=f"2024-01-{i:02d}T{i:02d}:00:00") for i in range(1, 15)]))
    matrix = trends.weekday_hour_matrix(trends.weekday_hour_counts(processed)).collect()
    assert [r["weekday"] for r in matrix] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert sum(v for r in matrix for v in r[1:] if v is not None) == 14
    strict = trends.weekday_hour_counts(processed, csv_dates_only=True).collect()
    assert [tuple(r) for r in strict] == [(None, None, 14)]


def test_null_profile(raw):
    rows = raw(record(), {}, {"Location": "x"})
    assert tuple(quality.null_profile(rows).first()) == (3, 1, 2)
    assert quality.non_empty_rows(rows).count() == 2


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text('ID,Case Number,Block\n1,C1,"say ""hi"", then go"\n2,,\n')
    rows = sources.read_csv(spark, str(path)).orderBy("ID").collect()
    assert [tuple(r) for r in rows] == [("1", "C1", 'say "hi", then go'), ("2", "", "")]
    assert sources.read_csv(spark, str(path), max_rows=1).count() == 1


def test_enrich_keeps_every_clean_row_with_a_date(raw):
    table = clean.clean(raw(*[record(ID=str(i)) for i in range(50)]))
    enriched = features.enrich(table)
    assert enriched.count() == 50
    assert enriched.filter("risk_score < 1 or risk_score > 10").count() == 0


def test_latest_per_id_repeats_whatever_the_order(spark):
    from beatline.operators.clean import latest_per_id

    rows = [("1", "C", "d", flag, ward) for flag in ("true", "false", None) for ward in ("1", "2")]
    kept = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        for parts in (1, 4):
            frame = spark.createDataFrame(order, "ID string, `Case Number` string, Date string, Arrest string, Ward string")
            kept.add(tuple(latest_per_id(frame.repartition(parts)).first()))
    assert len(kept) == 1


def test_staged_tables_go_when_dropped(spark):
    import os

    from beatline.session import Staging, shared_folder

    staging = Staging(spark)
    first = staging.write(spark.range(3), "numbers")
    path = staging.paths["numbers"]
    assert first.count() == 3 and path.startswith(shared_folder(spark))
    second = staging.write(first.where("id > 0"), "numbers")
    assert second.count() == 2 and not os.path.exists(path)
    path = staging.paths["numbers"]
    staging.drop("numbers", "never written")
    assert not os.path.exists(path)


def test_increments_leave_only_their_results(spark, tmp_path):
    import os

    from beatline.plans import extract
    from beatline.session import shared_folder

    rows = spark.createDataFrame([("2025-01-01T00:00:00.000", "9")], "`Updated On` string, ID string")
    folder = f"{shared_folder(spark)}/beatline"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    extract.run_increment(rows, f"{tmp_path}/cursor", sink_format="parquet", path=f"{tmp_path}/sent")
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before


def test_limited_export_is_not_written_by_one_task(spark, sf_dir, tmp_path, monkeypatch):
    from workload import catalog

    monkeypatch.setattr(catalog, "staging_path", lambda spark, name: f"{tmp_path}/{name}")
    # adaptive execution would make one part of the few test rows
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = catalog.queries()["csv_bootstrap_limited"](spark, sf_dir).orderBy("row_number").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(list((tmp_path / "csv" / "export").glob("part-*.csv"))) > 1
    names = [row["case_number"] for row in found]
    assert [row["row_number"] for row in found] == list(range(1, len(names) + 1)) and names == sorted(names)
