"""Cursors, increments and pages."""

import json
import random

import pytest
from pyspark.sql import functions as F

from beatline.plans import extract
from beatline.sinks.messages import api_layout, as_messages
from beatline.sinks.tables import save_cursor
from beatline.sources import changes

FOUR = [
    ("2025-01-01T00:00:00.000", "9"),
    ("2025-01-01T00:00:00.000", "10"),
    ("2025-01-02T00:00:00.000", "3"),
    (None, "4"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "`Updated On` string, ID string")


def cursor(spark, moment, number):
    return spark.createDataFrame([(moment, number)], "last_updated_on string, last_id string")


def ids(df):
    return sorted(r["ID"] for r in df.collect())


def test_keyset(spark):
    rows = table(spark, FOUR)
    assert ids(changes.changes_after(rows, cursor(spark, "2025-01-01T00:00:00.000", "9"))) == ["10", "3"]
    assert ids(changes.changes_after(rows, cursor(spark, "2025-01-01T00:00:00", "9"))) == ["10", "3"]
    assert ids(changes.full_load(rows)) == ["10", "3", "9"]
    assert ids(changes.incremental_load(rows, cursor(spark, None, None))) == ["10", "3", "9"]
    assert ids(changes.incremental_load(rows, cursor(spark, "2025-01-01T00:00:00.000", ""))) == ["10", "3", "9"]


def test_next_cursor(spark):
    old = cursor(spark, "2025-01-01T00:00:00.000", "9")
    after = lambda rows: tuple(changes.next_cursor(table(spark, rows), old).first())[:2]
    assert after(FOUR) == ("2025-01-02T00:00:00.000", "3")
    assert after(FOUR[:2]) == ("2025-01-01T00:00:00.000", "10")
    assert after([]) == ("2025-01-01T00:00:00.000", "9")
    assert after([("2025-03-01T00:00:00.000", None)]) == ("2025-03-01T00:00:00.000", "9")
    assert after([("2025-03-01T00:00:00.000", None), ("2025-02-01T00:00:00.000", "5")]) == (
        "2025-03-01T00:00:00.000",
        "5",
    )


def test_lookback(spark):
    now = cursor(spark, "2025-01-02T00:00:00.000", "3")
    assert tuple(changes.look_back(now, 24).first())[:2] == ("2025-01-01T00:00:00", "0")
    assert tuple(changes.look_back(now, 0).first())[:2] == ("2025-01-02T00:00:00.000", "3")
    unreadable = cursor(spark, "soon", "3")
    assert tuple(changes.look_back(unreadable, 24).first())[:2] == ("soon", "3")
    assert ids(changes.incremental_load(table(spark, FOUR), now, lookback_hours=24)) == ["10", "3", "9"]


def test_csv_cursor_compares_ids_as_text(spark):
    rows = table(spark, FOUR[:2])
    assert tuple(changes.csv_cursor(rows).first())[:2] == ("2025-01-01T00:00:00", "9")
    assert tuple(changes.csv_cursor(rows, numeric_id=True).first())[:2] == ("2025-01-01T00:00:00", "10")
    assert changes.csv_cursor(table(spark, [(None, "1")])).count() == 0


def test_csv_without_change_times_saves_no_cursor(spark, tmp_path):
    (tmp_path / "export.csv").write_text("ID,Updated On\n1,\n2,soon\n")
    sink = {"sink_format": "parquet", "path": f"{tmp_path}/sent"}
    at = extract.run_csv_bootstrap(spark, f"{tmp_path}/export.csv", f"{tmp_path}/cursor", max_rows=1, **sink)
    assert at.count() == 0 and spark.read.parquet(f"{tmp_path}/sent").count() == 1
    assert changes.load_cursor(spark, f"{tmp_path}/cursor").first()["last_id"] == "0"


def test_typed_change_time_reaches_the_scan(spark, tmp_path):
    typed = table(spark, FOUR).withColumn("Updated On", F.col("Updated On").cast("timestamp"))
    typed.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    changed = changes.changes_after(stored, cursor(spark, "2025-01-01T00:00:00", "9"))
    assert ids(changed) == ["10", "3"]
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(`Updated On`)" in plan or "IsNotNull(Updated On)" in plan
    assert tuple(changes.next_cursor(stored, cursor(spark, None, None)).first())[:2] == ("2025-01-02T00:00:00", "3")


def test_saved_cursor(spark, tmp_path):
    path = f"{tmp_path}/cursor"
    assert tuple(changes.load_cursor(spark, path).first())[:2] == (changes.START_TIME, changes.START_ID)
    save_cursor(cursor(spark, "2025-01-02T00:00:00", "3"), path)
    save_cursor(cursor(spark, "2025-01-01T00:00:00", "7"), path)
    assert tuple(changes.load_cursor(spark, path).first())[:2] == ("2025-01-01T00:00:00", "7")


@pytest.mark.parametrize("hot", ["none", "day", "second", "unnumbered"])
def test_pages_cover_the_table_in_order(spark, hot):
    """Page after page against a sort of the whole table."""
    draw = random.Random(hot)
    rows = []
    for i in range(600):
        day, hour, second = draw.randint(1, 9), draw.randint(0, 23), draw.randint(0, 59)
        if hot == "day" and i % 3:
            day = 4
        if hot in ("second", "unnumbered") and i % 3:
            day, hour, second = 4, 5, 6
        number = str(draw.randrange(10**8)) + str(i)
        rows.append((f"2025-01-{day:02d}T{hour:02d}:00:{second:02d}.000", number))
    if hot == "unnumbered":
        rows += [("2025-01-04T05:00:06.000", f"x{i}") for i in range(3)] + [("2025-01-09T23:59:59.000", "1")]
    stored = table(spark, rows)
    order = sorted(rows, key=lambda r: (r[0], not r[1].isdigit(), int(r[1]) if r[1].isdigit() else 0, r[1]))
    at, seen = ("1900-01-01T00:00:00", "0"), []
    for size in (7, 150, 300, 400, 400):
        page = [tuple(r) for r in changes.first_page(stored, cursor(spark, *at), size).collect()]
        seen += page
        at = page[-1] if page else at
    assert sorted(seen) == sorted(order)
    assert [r[0] for r in seen] == [r[0] for r in order]
    assert [r for r in seen if r[1].isdigit()] == [r for r in order if r[1].isdigit()]


def test_page_ends_with_all_ties(spark):
    rows = [("2025-01-01T00:00:00.000", "1")] * 3 + [("2025-01-01T00:00:00.000", "x"), ("2025-01-02T00:00:00.000", "2")]
    stored = table(spark, rows)
    first = changes.first_page(stored, changes.start_cursor(spark), 1)
    assert first.count() == 3
    second = changes.first_page(stored, changes.next_cursor(first, changes.start_cursor(spark)), 1)
    assert ids(second) == ["x"]
    third = changes.first_page(stored, changes.next_cursor(second, changes.start_cursor(spark)), 1)
    assert ids(third) == ["2"]


def test_typed_increments_send_the_last_records(spark, tmp_path):
    sink = {"sink_format": "parquet", "path": f"{tmp_path}/sent"}
    typed = table(spark, [("2025-01-01 12:00:00", "1"), ("2025-01-01 12:00:01.5", "2")])
    typed = typed.withColumn("Updated On", F.col("Updated On").cast("timestamp"))
    for _ in range(2):
        end = extract.run_increment(typed, f"{tmp_path}/cursor", **sink)
    assert tuple(end.first())[:2] == ("2025-01-01T12:00:01.500000", "2")
    assert sorted(r["key"] for r in spark.read.parquet(f"{tmp_path}/sent").collect()) == ["1", "2"]


def test_increments_send_each_record_once(spark, tmp_path):
    sink = {"sink_format": "parquet", "path": f"{tmp_path}/sent"}
    for rows in (FOUR[:2], FOUR, FOUR):
        end = extract.run_increment(table(spark, rows), f"{tmp_path}/cursor", **sink)
    assert tuple(end.first())[:2] == ("2025-01-02T00:00:00.000", "3")
    assert sorted(r["key"] for r in spark.read.parquet(f"{tmp_path}/sent").collect()) == ["10", "3", "9"]
    extract.run_increment(table(spark, FOUR), f"{tmp_path}/cursor", full=True, **sink)
    assert spark.read.parquet(f"{tmp_path}/sent").count() == 6


def test_increment_stops_at_the_end_it_fixed(spark):
    until = cursor(spark, "2025-01-01T00:00:00.000", "9")
    assert ids(changes.changes_until(table(spark, FOUR), until)) == ["9"]


def test_csv_bootstrap_then_increment(spark, tmp_path):
    (tmp_path / "export.csv").write_text("ID,Updated On\n10,01/01/2025 12:00:00 AM\n9,01/01/2025 12:00:00 AM\n")
    sink = {"sink_format": "parquet", "path": f"{tmp_path}/sent"}
    at = extract.run_csv_bootstrap(spark, f"{tmp_path}/export.csv", f"{tmp_path}/cursor", **sink)
    assert tuple(at.first())[:2] == ("2025-01-01T00:00:00", "9")
    extract.run_increment(table(spark, FOUR), f"{tmp_path}/cursor", **sink)
    assert sorted(r["key"] for r in spark.read.parquet(f"{tmp_path}/sent").collect()) == ["10", "10", "3", "9"]


def test_messages(spark):
    rows = spark.createDataFrame([("1", None, "41.5", "-87.5"), (None, "C2", None, None)],
                                 "ID string, `Case Number` string, Latitude string, Longitude string")
    full = [(r["key"], json.loads(r["value"])) for r in as_messages(rows).collect()]
    assert full[0] == ("1", {"ID": "1", "Case Number": None, "Latitude": "41.5", "Longitude": "-87.5"})
    assert full[1][0] is None
    api = [json.loads(r["value"]) for r in as_messages(api_layout(rows), keep_nulls=False, key="id").collect()]
    assert api[0] == {"id": "1", "latitude": "41.5", "longitude": "-87.5",
                      "location": {"latitude": "41.5", "longitude": "-87.5"}}
    assert api[1] == {"case_number": "C2"}
    numbered = as_messages(rows.drop("ID"))
    assert len({r["key"] for r in numbered.collect()}) == 2
