"""Commits, versions, feeds, upserts, and the numbers that are found by parts."""

import glob
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from beatline.commits import CommitConflict, CommitLog
from beatline.operators import areas, model_reports
from beatline.plans import etl, extract
from beatline.sinks import tables as sinks
from beatline.sources import changes, feed, tables as sources
from beatline.streaming import latest

PAIRS = "`Updated On` string, ID string"


# ---- commits ----


def test_one_of_two_writers_fails(spark, tmp_path):
    mine, other = CommitLog(spark, f"{tmp_path}/log"), CommitLog(spark, f"{tmp_path}/log")
    assert mine.newest() == (0, None)
    assert mine.add({"n": 1}, after=0) == 1
    with pytest.raises(CommitConflict):
        other.add({"n": 2}, after=0)
    assert other.add({"n": 2}, after=1) == 2 and mine.newest() == (2, {"n": 2})


def test_claimed_number_is_refused(spark, tmp_path, monkeypatch):
    """Both writers have seen the same last number: the store tells them apart."""
    log = CommitLog(spark, f"{tmp_path}/log")
    log.add({"n": 1})
    monkeypatch.setattr(log, "numbers", lambda: [])
    with pytest.raises(CommitConflict):
        log.add({"n": 2})


def test_unfinished_commit_is_passed_over(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    log.add({"n": 1})
    (tmp_path / "log" / f"{2:020d}.json").write_text("")
    (tmp_path / "log" / f"{3:020d}.json").write_text('{"n":')
    assert log.newest() == (1, {"n": 1})
    assert log.add({"n": 4}, after=1) == 4 and log.newest() == (4, {"n": 4})


def test_many_saves_leave_few_files(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log", kept=20)
    for n in range(1, 301):
        assert log.add({"n": n}) == n
    assert len(os.listdir(tmp_path / "log")) <= 40  # with the checksums of the local file system
    assert log.newest() == (300, {"n": 300})


def test_increment_beside_another_is_refused(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("2025-01-01T00:00:00.000", "9")], PAIRS)
    cursor, sink = f"{tmp_path}/cursor", {"sink_format": "parquet", "path": f"{tmp_path}/sent"}
    numbered = changes.numbered_cursor

    def overtaken(*arguments):
        found = numbered(*arguments)
        sinks.save_cursor(changes.start_cursor(spark), cursor)
        return found

    monkeypatch.setattr(changes, "numbered_cursor", overtaken)
    with pytest.raises(CommitConflict):
        extract.run_increment(rows, cursor, **sink)


# ---- missing IDs ----


def test_increments_end_although_last_ids_are_missing(spark, tmp_path):
    day = "2025-01-0{}T00:00:00.000".format
    rows = [(day(1), "5"), (day(1), None), (day(2), "7"), (day(2), None), (day(2), ""), (None, None)]
    sink = {"sink_format": "parquet", "path": f"{tmp_path}/sent"}
    source = spark.createDataFrame(rows, PAIRS)
    for sent in (5, 5, 5):
        extract.run_increment(source, f"{tmp_path}/cursor", **sink)
        assert spark.read.parquet(f"{tmp_path}/sent").count() == sent
    # what comes after them at the same time is new: IDs that are texts
    more = source.union(spark.createDataFrame([(day(2), "x"), (day(3), "1")], PAIRS))
    for sent in (7, 7):
        extract.run_increment(more, f"{tmp_path}/cursor", **sink)
        assert spark.read.parquet(f"{tmp_path}/sent").count() == sent


def test_pages_go_past_missing_ids(spark):
    rows = [("2025-01-01T00:00:00.000", "5"), ("2025-01-01T00:00:00.000", None), ("2025-01-02T00:00:00.000", "7")]
    source = spark.createDataFrame(rows, PAIRS)
    cursor, seen = changes.start_cursor(spark), []
    for _ in range(4):
        page = changes.first_page(source, cursor, 1)
        seen += [r["ID"] for r in page.collect()]
        cursor = changes.fixed(changes.next_cursor(page, cursor))
    assert seen == ["5", None, "7"]


def test_page_of_a_hot_second(spark):
    """Far more records in one second than a page holds."""
    rows = [("2025-01-01T00:00:00.000", str(i * 300_000)) for i in range(400)] + [("2025-01-01T00:00:00.000", None)] * 3
    random.Random(1).shuffle(rows)
    source = spark.createDataFrame(rows, PAIRS)
    cursor, seen = changes.start_cursor(spark), []
    for _ in range(9):
        page = changes.first_page(source, cursor, 50)
        seen += [r["ID"] for r in page.collect()]
        cursor = changes.fixed(changes.next_cursor(page, cursor))
    assert seen == [str(i * 300_000) for i in range(400)] + [None] * 3


# ---- versions of results ----


def test_readers_keep_the_old_rows_until_the_switch(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/result"
    sinks.replace_result(spark.range(3), path)

    def fails(*_, **__):
        raise OSError("no switch")

    with monkeypatch.context() as broken:
        broken.setattr(CommitLog, "add", fails)
        with pytest.raises(OSError):
            sinks.replace_result(spark.range(9), path)
    assert sources.read_result(spark, path).count() == 3
    begun = sources.read_result(spark, path)
    sinks.replace_result(spark.range(5), path, "json")
    assert begun.count() == 3 and sources.read_result(spark, path).count() == 5
    sinks.replace_result(spark.range(6), path)
    assert len(glob.glob(f"{path}/version-*")) == 2
    with pytest.raises(FileNotFoundError):
        sources.read_result(spark, f"{tmp_path}/nothing")


# ---- upserts ----


def test_upsert_touches_only_years_that_change(spark, raw, tmp_path):
    def delivery(name, *records):
        base = {"Case Number": "C", "Primary Type": "THEFT", "Updated On": "2024-06-01T00:00:00.000"}
        raw(*[base | {"ID": i, "Date": f"{y}-01-01T00:00:00", "Year": y} for i, y in records]).write.parquet(f"{tmp_path}/{name}")
        etl.run_upsert(spark, f"{tmp_path}/{name}", f"{tmp_path}/processed")

    def stored():
        return sorted((r["ID"], r["Year"]) for r in spark.read.parquet(f"{tmp_path}/processed").collect())

    delivery("first", ("1", "2020"), ("2", "2021"), ("3", "2022"), ("4", "2022"))
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/processed/Year=2020/*.parquet")}
    # one row stays in its year, one moves, one is new, and its old year is left empty
    delivery("second", ("3", "2022"), ("2", "2023"), ("5", "2023"))
    assert stored() == [("1", 2020), ("2", 2023), ("3", 2022), ("4", 2022), ("5", 2023)]
    assert before == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/processed/Year=2020/*.parquet")}
    assert not glob.glob(f"{tmp_path}/processed/Year=2021/*.parquet")


def test_etl_keeps_pushed_filters(spark, raw, tmp_path):
    raw({"ID": "1"}).write.parquet(f"{tmp_path}/raw")
    plan = etl.process(sources.read_raw(spark, f"{tmp_path}/raw"))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert all(f"IsNotNull({c})" in pushed for c in ("ID", "Date", "`Primary Type`", "Year")), pushed


# ---- rows of exports ----


def test_rows_are_numbered_over_files_and_parts(spark, tmp_path):
    n = 0
    for name in ("a", "b", "c"):
        lines = ["Name,Note"]
        for _ in range(700):
            n += 1
            lines.append(f"row {n},{'x' * (n % 50)}")
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    part = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = sources.read_csv(spark, str(tmp_path), row_number="number").collect()
        first = sources.read_csv(spark, str(tmp_path), max_rows=1000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    assert sorted((r["number"], r["Name"]) for r in rows) == [(i, f"row {i}") for i in range(1, n + 1)]
    assert {r["Name"] for r in first} == {f"row {i}" for i in range(1, 1001)}
    assert len(first) == 1000 and first[0].asDict().keys() == {"Name", "Note"}


# ---- the feed ----


def _take(spark, folder):
    query = feed.stream_changes(spark, f"{folder}/feed").writeStream.format("parquet").option("path", f"{folder}/taken")
    query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return [(r["Updated On"], r["ID"]) for r in spark.read.parquet(f"{folder}/taken").collect()]


def test_feed_gives_each_change_once(spark, tmp_path):
    day = "2025-01-0{}T00:00:00.000".format
    first = [(day(1), "9"), (day(1), "10"), (day(2), "3"), (day(2), None), (None, "4")]
    second = [(day(2), "a"), (day(2), "b"), (day(3), None)]
    key = lambda pair: (pair[0], pair[1] or "")
    feed.append_changes(spark.createDataFrame(first, PAIRS), f"{tmp_path}/feed")
    assert sorted(_take(spark, tmp_path), key=key) == sorted(first[:4], key=key)
    assert len(_take(spark, tmp_path)) == 4
    feed.append_changes(spark.createDataFrame(second, PAIRS), f"{tmp_path}/feed")
    # a delivery that is not complete is not seen
    unfinished = feed.append_changes(spark.createDataFrame([(day(9), "1")], PAIRS), f"{tmp_path}/feed")
    os.rename(f"{unfinished}/_SUCCESS", f"{unfinished}/_WAIT")
    assert sorted(_take(spark, tmp_path), key=key) == sorted(first[:4] + second, key=key)
    os.rename(f"{unfinished}/_WAIT", f"{unfinished}/_SUCCESS")
    assert len(_take(spark, tmp_path)) == 8 and len(_take(spark, tmp_path)) == 8


# ---- the latest records of a stream ----


def test_latest_stream_forgets_old_days(spark, raw, tmp_path):
    def deliver(*records):
        base = {"Date": "d", "Primary Type": "THEFT"}
        rows = raw(*[base | {"ID": i, "Case Number": c, "Updated On": u} for i, c, u in records])
        rows.write.mode("append").parquet(f"{tmp_path}/records")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/records")
        query = latest.follow_latest(stream, f"{tmp_path}/sent", f"{tmp_path}/checkpoint", delay="2 days")
        query.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        found = {r["ID"]: r["Case Number"] for r in latest.read_latest(spark, f"{tmp_path}/sent").collect()}
        return held[-1] if held else None, found

    held, found = deliver(*[(str(i), "old", "2025-01-01T00:00:00.000") for i in range(50)])
    assert held == 50 and set(found.values()) == {"old"}
    # an update two days late counts, one without a time and one without an ID do not
    _, found = deliver(
        ("1", "new", "2025-01-02T00:00:00.000"), ("2", "older", "2024-12-31T12:00:00.000"), ("3", "x", None), (None, "x", "2025-01-02T00:00:00.000")
    )
    assert (found["1"], found["2"], found["3"]) == ("new", "old", "old") and len(found) == 50
    held, found = deliver(("4", "newest", "2025-03-01T00:00:00.000"))
    assert held <= 1 and found["4"] == "newest" and len(found) == 50


def test_latest_stream_ranks_copies_as_the_table_does(spark, raw, tmp_path):
    from beatline.operators.clean import latest_per_id

    records = [
        {"ID": str(i % 7), "Case Number": f"C{i % 3}", "Date": "d", "Updated On": "2025-01-01T00:00:00.000", "Ward": str(i)}
        for i in range(60)
    ]
    rows = raw(*records)
    rows.repartition(5).write.parquet(f"{tmp_path}/records")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/records")
    latest.follow_latest(stream, f"{tmp_path}/sent", f"{tmp_path}/checkpoint").awaitTermination()
    kept = latest.read_latest(spark, f"{tmp_path}/sent").select("ID", "Ward").collect()
    assert sorted(kept) == sorted(latest_per_id(rows).select("ID", "Ward").collect()) and len(kept) == 7


def test_latest_per_id_tells_a_null_from_a_text(spark):
    from beatline.operators.clean import latest_per_id

    rows = [("1", "C", "d", *pair) for pair in ((None, "a"), ("a", None), ("a", "a"), (None, None))]
    names = "ID string, `Case Number` string, Date string, Arrest string, Ward string"
    kept = {tuple(latest_per_id(spark.createDataFrame(order, names)).first()) for order in (rows, rows[::-1])}
    assert len(kept) == 1


# ---- reports ----


def test_area_under_roc_over_many_ranges(spark):
    draw = random.Random(4)
    rows = [(float(draw.random() < 0.3), draw.random() if i % 5 else 0.5) for i in range(4000)]
    rows += [(None, 0.1), (1.0, None), (0.0, math.nan)]
    ones = [s for label, s in rows if label == 1.0 and s is not None]
    zeros = [s for label, s in rows if label == 0.0 and s is not None and not math.isnan(s)]
    won = sum((p > q) + (p == q) / 2 for p in ones for q in zeros)
    frame = spark.createDataFrame(rows, "label double, p double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert model_reports.area_under_roc(frame, "label", "p") == pytest.approx(won / len(ones) / len(zeros), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert model_reports.area_under_roc(frame.where("label = 1"), "label", "p") == 0.0


def test_heat_spreads_as_its_kernel_says(spark):
    places = [(0.5, 0.5), (0.5, 0.5), (3.5, -2.5), (None, 1.0)]
    frame = spark.createDataFrame(places, "Latitude double, Longitude double")
    found = {
        (r["zoom"], r["lat_cell"], r["lon_cell"]): r["density"]
        for r in areas.heat_density(frame, cell=1.0, zooms=2, radius=3, blur=2).collect()
    }
    wanted = {}
    for zoom in (0, 1):
        for latitude, longitude in places[:3]:
            y, x = math.floor(latitude) >> zoom, math.floor(longitude) >> zoom
            for dy in range(-3, 4):
                for dx in range(-3, 4):
                    weight = math.floor(1000 * min(1.0, (3 - math.hypot(dy, dx)) / 2))
                    if weight > 0:
                        at = (zoom, y + dy, x + dx)
                        wanted[at] = wanted.get(at, 0) + weight
    assert found == {at: n / 1000 for at, n in wanted.items()}
    with pytest.raises(ValueError):
        areas.heat_density(frame, radius=2, blur=3)
