"""Registered queries by name; each takes the session and a folder of tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from beatline import schema
from beatline.functions import times
from beatline.operators import areas, clean, features, learning, model_reports, quality, trends
from beatline.plans import etl, extract, reports, training
from beatline.session import apply_settings, staged, staging_path
from beatline.sinks import messages as message_sink, tables as table_sink
from beatline.sources import boundaries, changes, feed, messages as message_source, runs, tables
from beatline.streaming import ingest, latest
from workload import derive

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_settings(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.raw_incidents(spark, sf_dir).drop("event_id")


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.process(_raw(spark, sf_dir))


def _plain_time(column: str):
    """Without a zone, as the other engine has it."""
    return F.col(column).cast("timestamp_ntz").alias(column)


# ---- cleaning ----


@_query
def clean_incidents(spark, sf_dir):
    return clean.clean(_raw(spark, sf_dir))


@_query
def dedup_latest(spark, sf_dir):
    latest = _raw(spark, sf_dir).transform(clean.require_columns).transform(clean.latest_per_id)
    return latest.select("ID", "Case Number", "Updated On")


@_query
def clean_missing_columns(spark, sf_dir):
    raw = _raw(spark, sf_dir).drop("Arrest", "Domestic", "Beat", "Ward", "X Coordinate", "Y Coordinate")
    return etl.process(raw).select("ID", "was_arrest_made", "is_domestic_incident", "risk_score")


# ---- features ----


@_query
def time_features(spark, sf_dir):
    timed = features.add_time_features(clean.clean(_raw(spark, sf_dir)))
    return timed.select(
        "ID",
        _plain_time("crime_datetime"),
        "Year",
        "crime_year",
        "crime_month",
        "crime_day",
        "crime_hour",
        "crime_day_of_week",
        "time_of_day",
        "season",
    )


@_query
def parse_updated_on(spark, sf_dir):
    moment = F.col("ts")
    layouts = [
        F.date_format(moment, "MM/dd/yyyy hh:mm:ss a"),
        F.date_format(moment, "MM/dd/yyyy HH:mm:ss"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
        F.concat(F.lit("  "), F.date_format(moment, "yyyy-MM-dd HH:mm:ss"), F.lit("\t")),
        F.lit("soon"),
    ]
    text = F
    for i, layout in enumerate(layouts):
        text = text.when(F.col("event_id") % len(layouts) == i, layout)
    changed = times.change_time(text).cast("timestamp_ntz")
    return derive.events(spark, sf_dir).select("event_id", changed.alias("changed_at"))


@_query
def location_category(spark, sf_dir):
    return (
        _processed(spark, sf_dir)
        .groupBy("Location Description", "location_category")
        .agg(F.count("*").alias("n"))
    )


@_query
def crime_features(spark, sf_dir):
    return _processed(spark, sf_dir).select(
        "ID",
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
    )


@_query
def risk_score(spark, sf_dir):
    return _processed(spark, sf_dir).select("ID", "risk_score")


def _etl_tables(spark, sf_dir):
    """Raw table written, processed table built from it: its path and the row counts of the run."""
    raw_path, processed_path = staging_path(spark, "raw"), staging_path(spark, "processed")
    _raw(spark, sf_dir).write.parquet(raw_path)
    return processed_path, etl.run_etl(spark, raw_path, processed_path)


@_query
def processed_roundtrip(spark, sf_dir):
    path, _ = _etl_tables(spark, sf_dir)
    columns = [_plain_time(c) if c == "crime_datetime" else F.col(c) for c in schema.PROCESSED_COLUMNS]
    return tables.read_processed(spark, path).select(*columns)


@_query
def etl_row_counts(spark, sf_dir):
    _, counts = _etl_tables(spark, sf_dir)
    return spark.createDataFrame([counts], "raw_rows bigint, processed_rows bigint")


# ---- trends ----


@_query
def yearly_trend(spark, sf_dir):
    return trends.yearly_counts(_processed(spark, sf_dir))


@_query
def type_counts(spark, sf_dir):
    return trends.type_counts(_processed(spark, sf_dir))


@_query
def top20_types(spark, sf_dir):
    return trends.type_counts(_processed(spark, sf_dir), top=20)


@_query
def hourly_by_day_type(spark, sf_dir):
    return trends.hourly_by_day_type(_processed(spark, sf_dir))


@_query
def arrest_rate_top20(spark, sf_dir):
    return trends.arrest_rate_by_type(_processed(spark, sf_dir))


@_query
def district_stats(spark, sf_dir):
    return trends.district_stats(_processed(spark, sf_dir))


@_query
def night_risk_by_district(spark, sf_dir):
    return trends.night_risk_by_district(_processed(spark, sf_dir))


@_query
def night_risk_by_district_wide(spark, sf_dir):
    return trends.night_risk_by_district(
        _processed(spark, sf_dir), night=times.in_night(F.col("crime_hour"), 22, 6)
    )


@_query
def night_risk_quadrants(spark, sf_dir):
    return reports.night_risk(_processed(spark, sf_dir)).withColumns(
        {c: F.round(c, 9) for c in ("avg_night", "avg_arrest")}
    )


@_query
def weekday_hour_counts(spark, sf_dir):
    return trends.weekday_hour_counts(_processed(spark, sf_dir))


@_query
def weekday_hour_counts_strict(spark, sf_dir):
    return trends.weekday_hour_counts(_processed(spark, sf_dir), csv_dates_only=True)


@_query
def weekday_hour_matrix(spark, sf_dir):
    return trends.weekday_hour_matrix(trends.weekday_hour_counts(_processed(spark, sf_dir)))


@_query
def row_counts(spark, sf_dir):
    return trends.row_counts(_raw(spark, sf_dir), _processed(spark, sf_dir))


@_query
def result_table_replace(spark, sf_dir):
    folder = staging_path(spark, "results")
    processed = _processed(spark, sf_dir)
    # what an earlier run left is gone after the second one
    table_sink.replace_result(trends.type_counts(processed), f"{folder}/crime_by_year")
    table_sink.replace_result(reports.result_collections(processed)["crime_by_year"], f"{folder}/crime_by_year")
    return tables.read_result(spark, f"{folder}/crime_by_year")


def _collection(name):
    """A collection as a reader finds it after it was published over an older version."""

    def published(spark, sf_dir):
        path = f"{staging_path(spark, 'results')}/{name}"
        table_sink.replace_result(spark.range(1), path)
        table_sink.replace_result(reports.result_collections(_processed(spark, sf_dir))[name], path)
        return tables.read_result(spark, path)

    published.__name__ = f"collection_{name}"
    return _query(published)


for _name in ("crime_by_year", "hourly_patterns", "arrest_rates", "district_analysis"):
    _collection(_name)


@_query
def processed_upsert(spark, sf_dir):
    """A processed table of most records, then a delivery of the rest: rows move to other years, others are new."""
    folder = staging_path(spark, "upsert")
    raw = derive.raw_incidents(spark, sf_dir)
    later = F.col("event_id") % 10 == 9
    for name, part in (("first", raw.where(~later)), ("second", raw.where(later))):
        part.drop("event_id").write.parquet(f"{folder}/{name}")
        etl.run_upsert(spark, f"{folder}/{name}", f"{folder}/processed")
    stored = tables.read_processed(spark, f"{folder}/processed")
    return stored.select("ID", "Case Number", "Year", "crime_category", "risk_score")


# ---- areas ----


@_query
def community_area_counts(spark, sf_dir):
    return areas.area_counts(_processed(spark, sf_dir))


def _boundary_file(spark, sf_dir):
    """A feature collection of the areas that occur, one that does not, and two unreadable ones."""
    area = (F.col("user_id") % 77 + 1).cast("string")
    known = derive.events(spark, sf_dir).select(area.alias("area_numbe")).distinct()
    others = spark.createDataFrame([("78",), ("abc",), (None,)], "area_numbe string")
    name = F.coalesce(F.concat(F.lit("AREA "), F.col("area_numbe")), F.lit("NO AREA"))
    feature = F.struct(F.struct("area_numbe", name.alias("community")).alias("properties"))
    path = staging_path(spark, "boundaries")
    known.union(others).agg(F.collect_list(feature).alias("features")).write.json(path)
    return path


def _map_tables(spark, sf_dir):
    shapes = boundaries.read_boundaries(spark, _boundary_file(spark, sf_dir))
    return reports.choropleth(_processed(spark, sf_dir), shapes, "area_numbe")


@_query
def area_counts_on_boundaries(spark, sf_dir):
    named = [F.col("properties").getItem(key).alias(key) for key in ("area_numbe", "community")]
    return _map_tables(spark, sf_dir)["boundaries"].select(*named, "crime_count")


@_query
def area_counts_on_numbered_boundaries(spark, sf_dir):
    """Boundaries whose area keys are JSON numbers, whole ones with and without a fraction of 0, and texts."""
    area = F.col("user_id") % 77 + 1
    written = F.when(area % 3 == 0, F.concat(area, F.lit(".0"))).when(area % 3 == 1, area.cast("string"))
    written = F.coalesce(written, F.concat(F.lit('"'), area, F.lit('.0"')))
    known = derive.events(spark, sf_dir).select(written.alias("key"), area.alias("area")).distinct()
    feature = F.concat(F.lit('{"properties":{"area_numbe":'), "key", F.lit(',"area":"'), "area", F.lit('"}}'))
    features = F.array_join(F.collect_list(feature), ",")
    path = staging_path(spark, "boundaries")
    known.agg(F.concat(F.lit('{"features":['), features, F.lit("]}")).alias("value")).write.text(path)
    counts = areas.area_counts(_processed(spark, sf_dir))
    found = areas.counts_on_boundaries(boundaries.read_boundaries(spark, path), counts, "area_numbe")
    return found.select(F.col("properties").getItem("area").cast("bigint").alias("area"), "crime_count")


@_query
def choropleth_bins(spark, sf_dir):
    edges = areas.class_edges(areas.area_counts(_processed(spark, sf_dir)))
    return edges.select(F.posexplode("edges").alias("position", "edge"))


@_query
def choropleth_bins_large(spark, sf_dir):
    """Counts of a table a thousand million times as large."""
    counts = areas.area_counts(_processed(spark, sf_dir))
    edges = areas.class_edges(counts.withColumn("crime_count", F.col("crime_count") * F.lit(10**9)))
    return edges.select(F.posexplode("edges").alias("position", "edge"))


@_query
def choropleth_classes(spark, sf_dir):
    return _map_tables(spark, sf_dir)["areas"]


@_query
def heat_grid(spark, sf_dir):
    return areas.heat_grid(_processed(spark, sf_dir))


@_query
def heat_density(spark, sf_dir):
    return areas.heat_density(_processed(spark, sf_dir), cell=0.01)


@_query
def coordinate_sample(spark, sf_dir):
    return areas.sample_coordinates(_processed(spark, sf_dir))


# ---- messages and quality ----


def _run_ingest(spark, source, raw_path, checkpoint):
    stream = message_source.stream_messages(spark, "text", source)
    ingest.ingest(stream, raw_path, checkpoint).awaitTermination()


@_query
def stream_ingest(spark, sf_dir):
    folder = staging_path(spark, "stream")
    derive.messages(spark, sf_dir).select("value").write.text(f"{folder}/messages")
    _run_ingest(spark, f"{folder}/messages", f"{folder}/raw", f"{folder}/checkpoint")
    return tables.read_raw(spark, f"{folder}/raw")


@_query
def stream_restart(spark, sf_dir):
    """Two deliveries with a run after each, and one more run that finds nothing new."""
    folder = staging_path(spark, "stream")
    sent = derive.messages(spark, sf_dir)
    late = F.col("kind") == "view"
    for delivery in (sent.filter(~late), sent.filter(late), None):
        if delivery is not None:
            delivery.select("value").write.mode("append").text(f"{folder}/messages")
        _run_ingest(spark, f"{folder}/messages", f"{folder}/raw", f"{folder}/checkpoint")
    return tables.read_raw(spark, f"{folder}/raw")


@_query
def stream_latest(spark, sf_dir):
    """Three deliveries of messages, each with records of the whole month: the last record of each ID."""
    folder = staging_path(spark, "latest")
    sent = derive.messages(spark, sf_dir)
    early, middle = F.col("kind") == "view", F.col("kind").isin("click", "error")
    for delivery in (sent.where(early), sent.where(middle), sent.where(~early & ~middle)):
        delivery.select("value").write.mode("append").text(f"{folder}/messages")
        records = ingest.parse_messages(message_source.stream_messages(spark, "text", f"{folder}/messages"))
        latest.follow_latest(records, f"{folder}/sent", f"{folder}/checkpoint", delay="60 days").awaitTermination()
    return latest.read_latest(spark, f"{folder}/sent").select("ID", "Case Number", "Updated On")


@_query
def change_stream(spark, sf_dir):
    """Changes of a feed with ties, IDs that are no numbers and missing IDs, in two deliveries; a third run finds nothing new."""
    folder = staging_path(spark, "feed")
    source = staged(_tied_source(spark, sf_dir, missing=True), "source")
    middle = source.agg(F.percentile_approx(F.unix_seconds(times.change_time(F.col("Updated On"))), 0.5)).scalar()
    second = F.unix_seconds(times.change_time(F.col("Updated On")))
    # records of one moment are in both deliveries: those with a number are in the first
    early = (second < middle) | ((second == middle) & F.coalesce(F.col("ID").try_cast("bigint").isNotNull(), F.lit(False)))
    for delivery in (source.where(early), source.where(~early), None):
        if delivery is not None:
            feed.append_changes(delivery, f"{folder}/feed")
        changed = feed.stream_changes(spark, f"{folder}/feed").writeStream.format("parquet")
        changed = changed.option("path", f"{folder}/taken").option("checkpointLocation", f"{folder}/checkpoint")
        changed.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/taken").select("ID", "Case Number", "Updated On")


@_query
def publish_messages(spark, sf_dir):
    path = staging_path(spark, "published")
    message_sink.publish(message_sink.as_messages(_raw(spark, sf_dir)), "parquet", path)
    return message_source.read_messages(spark, "parquet", path).select("key", "value")


@_query
def message_quality(spark, sf_dir):
    sent = derive.messages(spark, sf_dir).select(F.col("value").cast("binary").alias("value"))
    return quality.message_quality(sent)


@_query
def all_null_messages(spark, sf_dir):
    """The messages that have no field of the API layout, all of them."""
    return quality.all_null_messages(derive.messages(spark, sf_dir))


@_query
def non_empty_rows(spark, sf_dir):
    rows = quality.non_empty_rows(ingest.parse_messages(derive.messages(spark, sf_dir)))
    return rows.select("ID", "Case Number", "Date", "Arrest", "Location")


@_query
def raw_null_profile(spark, sf_dir):
    return quality.null_profile(ingest.parse_messages(derive.messages(spark, sf_dir)))


# ---- changes ----


def _source(spark, sf_dir):
    """The table that changes are taken from; some records have no change time."""
    known = F.col("event_id") % 59 != 9
    return (
        derive.raw_incidents(spark, sf_dir)
        .withColumn("Updated On", F.when(known, F.col("Updated On")))
        .drop("event_id")
    )


def _first_half(source):
    """Records changed in the first half of the time covered."""
    changed = times.change_time(F.col("Updated On"))
    second = F.unix_seconds(changed)
    middle = source.agg(F.floor((F.min(second) + F.max(second)) / 2)).scalar()
    return source.filter(second <= middle)


def _half_cursor(spark, source):
    """The cursor saved after the first half was taken."""
    path = staging_path(spark, "cursor")
    taken = changes.next_cursor(_first_half(source), changes.start_cursor(spark))
    table_sink.save_cursor(taken, path)
    return changes.load_cursor(spark, path)


@_query
def full_load(spark, sf_dir):
    return changes.full_load(_source(spark, sf_dir)).select("ID", "Case Number", "Updated On")


@_query
def incremental_load(spark, sf_dir):
    source = _source(spark, sf_dir)
    changed = changes.incremental_load(source, _half_cursor(spark, source))
    return changed.select("ID", "Case Number", "Updated On")


@_query
def incremental_load_typed(spark, sf_dir):
    """The same on a stored table whose change time is a timestamp."""
    moment = times.change_time(F.col("Updated On"))
    source = staged(_source(spark, sf_dir).withColumn("Updated On", moment), "typed")
    first = source.where(F.unix_seconds("Updated On") <= source.agg(
        F.floor((F.min(F.unix_seconds("Updated On")) + F.max(F.unix_seconds("Updated On"))) / 2)
    ).scalar())
    cursor = changes.fixed(changes.next_cursor(first, changes.start_cursor(spark)))
    changed = changes.incremental_load(source, cursor)
    return changed.select("ID", "Case Number", _plain_time("Updated On"))


@_query
def incremental_lookback(spark, sf_dir):
    source = _source(spark, sf_dir)
    changed = changes.incremental_load(source, _half_cursor(spark, source), lookback_hours=24)
    return changed.select("ID", "Case Number", "Updated On")


@_query
def keyset_page(spark, sf_dir):
    source = _source(spark, sf_dir)
    return changes.first_page(source, _half_cursor(spark, source), size=1000).select("ID", "Updated On")


@_query
def keyset_pages_union(spark, sf_dir):
    """Page after page of a source with ties and IDs that are no numbers: all records with a change time."""
    return _all_pages(spark, staged(_tied_source(spark, sf_dir), "source"))


@_query
def keyset_pages_missing_ids(spark, sf_dir):
    """Page after page where some records, the last ones too, have no ID."""
    return _all_pages(spark, staged(_tied_source(spark, sf_dir, missing=True), "source"))


def _tied_source(spark, sf_dir, missing=False):
    """Records whose change time is cut to the hour, some with IDs that are no numbers; with ``missing`` those of the last hour have none."""
    event = F.col("event_id")
    hour = F.concat(F.substring("Updated On", 1, 13), F.lit(":00:00.000"))
    source = derive.raw_incidents(spark, sf_dir).select(
        F.when(event % 50 == 0, F.concat(F.lit("x"), event % 7)).otherwise(F.col("ID")).alias("ID"),
        "Case Number",
        F.when(event % 59 != 9, hour).alias("Updated On"),
        "event_id",
    )
    if missing:
        last = F.col("Updated On") == source.agg(F.max("Updated On")).scalar()
        gone = (event % 40 == 3) | F.coalesce(last, F.lit(False))
        source = source.withColumn("ID", F.when(~gone, F.col("ID")))
    return source.drop("event_id")


def _all_pages(spark, source):
    cursor, pages = changes.start_cursor(spark), []
    size = source.count() // 3 + 1
    while True:
        page = staged(changes.first_page(source, cursor, size), "page")
        if page.isEmpty():
            return reduce(DataFrame.unionByName, pages, page)
        pages.append(page)
        cursor = changes.fixed(changes.next_cursor(page, cursor))


@_query
def dedup_ties(spark, sf_dir):
    """Every record twice with different flags and no change time: the choice still repeats."""
    raw = _raw(spark, sf_dir).withColumn("Updated On", F.lit(None).cast("string")).where(F.col("ID").isNotNull())
    flags = F.array(F.lit(None).cast("string"), F.lit("true"))
    copies = raw.drop("Arrest").withColumn("Arrest", F.explode(flags)).select(*raw.columns)
    return clean.latest_per_id(copies, portable_ties=True).select("ID", "Case Number", "Arrest")


@_query
def next_cursor(spark, sf_dir):
    source = _source(spark, sf_dir)
    cursor = _half_cursor(spark, source)
    following = changes.next_cursor(changes.incremental_load(source, cursor), cursor)
    return following.select("last_updated_on", "last_id")


@_query
def csv_bootstrap(spark, sf_dir):
    folder = staging_path(spark, "csv")
    _raw(spark, sf_dir).write.option("header", True).option("escape", '"').csv(f"{folder}/export")
    cursor = extract.run_csv_bootstrap(
        spark, f"{folder}/export", f"{folder}/cursor", sink_format="parquet", path=f"{folder}/published"
    )
    sent = spark.read.parquet(f"{folder}/published").agg(F.count("*").alias("n"))
    return cursor.select(sent.scalar().alias("rows_sent"), "last_updated_on", "last_id")


@_query
def csv_bootstrap_multiline(spark, sf_dir):
    """An export whose descriptions hold line breaks and quotes: each record is one message."""
    folder = staging_path(spark, "csv")
    text = F.concat(F.lit('said "'), F.col("Description"), F.lit('",\nthen left'))
    rows = _raw(spark, sf_dir).withColumn("Description", text)
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/export")
    sink = {"sink_format": "parquet", "path": f"{folder}/published"}
    extract.run_csv_bootstrap(spark, f"{folder}/export", f"{folder}/cursor", multi_line=True, **sink)
    value = F.col("value")
    return spark.read.parquet(f"{folder}/published").select(
        "key",
        F.get_json_object(value, "$['Case Number']").alias("case_number"),
        F.get_json_object(value, "$.Description").alias("description"),
    )


@_query
def csv_bootstrap_two_layouts(spark, sf_dir):
    """Exports of two layouts, read one by one: together their records, and a cursor over both."""
    folder = staging_path(spark, "csv")
    raw = derive.raw_incidents(spark, sf_dir)
    odd = F.col("event_id") % 2 == 1
    raw.where(~odd).drop("event_id").write.option("header", True).option("escape", '"').csv(f"{folder}/a")
    raw.where(odd).select("Updated On", "ID", "Date").write.option("header", True).option("escape", '"').csv(f"{folder}/b")
    sink = {"sink_format": "parquet", "path": f"{folder}/published"}
    cursors = [
        extract.run_csv_bootstrap(spark, f"{folder}/{name}", f"{folder}/cursor-{name}", **sink) for name in ("a", "b")
    ]
    last = reduce(DataFrame.union, cursors).agg(F.max(F.struct("last_updated_on", "last_id")).alias("c"))
    sent = spark.read.parquet(f"{folder}/published").agg(F.count("*").alias("n"))
    return last.select(sent.scalar().alias("rows_sent"), "c.last_updated_on", "c.last_id")


@_query
def csv_bootstrap_no_id(spark, sf_dir):
    """An export without IDs whose change time has its API name."""
    folder = staging_path(spark, "csv")
    rows = _raw(spark, sf_dir).drop("ID").withColumnRenamed("Updated On", "updated_on")
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/export")
    cursor = extract.run_csv_bootstrap(
        spark, f"{folder}/export", f"{folder}/cursor", sink_format="parquet", path=f"{folder}/published"
    )
    sent = spark.read.parquet(f"{folder}/published").agg(F.count_distinct("key").alias("n"))
    return cursor.select(sent.scalar().alias("rows_sent"), "last_updated_on", "last_id")


@_query
def csv_bootstrap_limited(spark, sf_dir):
    """The first rows of an export without IDs: their keys are the numbers of the rows, whatever parts the file is read in."""
    folder = staging_path(spark, "csv")
    # sorted parts, whose files have paths in the same order: no task writes all rows
    rows = _raw(spark, sf_dir).drop("ID").orderBy("Case Number")
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/export")
    part = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        limit = _raw(spark, sf_dir).count() // 2
        sink = {"sink_format": "parquet", "path": f"{folder}/published"}
        extract.run_csv_bootstrap(spark, f"{folder}/export", f"{folder}/cursor", max_rows=limit, **sink)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    sent = spark.read.parquet(f"{folder}/published")
    return sent.select(F.col("key").cast("bigint").alias("row_number"), F.get_json_object("value", "$['Case Number']").alias("case_number"))


@_query
def increment_runs_typed(spark, sf_dir):
    """Three increments over a typed change time with fractions of seconds: each record is sent once, the last too."""
    folder = staging_path(spark, "increments")
    moment = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 1000 * 1000)
    source = derive.events(spark, sf_dir).select(F.col("event_id").cast("string").alias("ID"), moment.alias("Updated On"))
    middle = source.agg(F.percentile_approx("Updated On", 0.5)).scalar()
    for table in (source.where(F.col("Updated On") <= middle), source, source):
        extract.run_increment(table, f"{folder}/cursor", sink_format="parquet", path=f"{folder}/published")
    sent = spark.read.parquet(f"{folder}/published").agg(F.count("*").alias("n"))
    return changes.load_cursor(spark, f"{folder}/cursor").select(
        sent.scalar().alias("messages"), "last_updated_on", "last_id"
    )


@_query
def increment_runs(spark, sf_dir):
    """A first increment over half the records, then one over all: each record is sent once."""
    folder = staging_path(spark, "increments")
    source = _source(spark, sf_dir)
    for table in (_first_half(source), source):
        extract.run_increment(table, f"{folder}/cursor", sink_format="parquet", path=f"{folder}/published")
    sent = spark.read.parquet(f"{folder}/published").agg(F.count("*").alias("n"))
    return changes.load_cursor(spark, f"{folder}/cursor").select(
        sent.scalar().alias("messages"), "last_updated_on", "last_id"
    )


# ---- model input ----


def _frame(spark, sf_dir):
    return learning.feature_frame(_processed(spark, sf_dir), learning.CRIME_TYPE)


def _prepared(spark, sf_dir):
    return training.prepare(_processed(spark, sf_dir), learning.CRIME_TYPE)


@_query
def ml_feature_frame(spark, sf_dir):
    return _frame(spark, sf_dir).withColumn("crime_datetime", _plain_time("crime_datetime"))


@_query
def ml_feature_frame_weekends(spark, sf_dir):
    """The frame with Saturdays and Sundays as weekend."""
    frame = learning.feature_frame(_processed(spark, sf_dir), learning.CRIME_TYPE, weekend_days=(1, 7))
    return frame.select("ID", "crime_day_of_week", "is_weekend")


@_query
def ml_domestic_frame(spark, sf_dir):
    frame = learning.feature_frame(_processed(spark, sf_dir), learning.DOMESTIC)
    return frame.withColumn("crime_datetime", _plain_time("crime_datetime"))


@_query
def ml_sample(spark, sf_dir):
    return learning.sample(_frame(spark, sf_dir)).select("ID")


@_query
def ml_split(spark, sf_dir):
    return learning.split(learning.sample(_frame(spark, sf_dir))).select("ID", "is_train")


@_query
def top_location_descriptions(spark, sf_dir):
    return learning.top_locations(learning.sample(_frame(spark, sf_dir)))


@_query
def location_topn_collapse(spark, sf_dir):
    return _prepared(spark, sf_dir).select("ID", "loc_desc_topN")


@_query
def categorical_cardinality(spark, sf_dir):
    return learning.cardinality(_prepared(spark, sf_dir), list(learning.CATEGORICAL))


@_query
def label_distribution(spark, sf_dir):
    frame = learning.feature_frame(_processed(spark, sf_dir), learning.DOMESTIC)
    label = F.col(learning.DOMESTIC.target).cast("double")
    return learning.label_distribution(frame.withColumn("label", label), "label")


# ---- models ----

_TRAINED: dict[tuple, training.Training] = {}


def forget_trainings() -> None:
    _TRAINED.clear()


def _trained(spark, sf_dir, task):
    """One training per session, data and task, shared by the queries that show its parts."""
    key = (spark.sparkContext.applicationId, sf_dir, task.name)
    if key not in _TRAINED:
        _TRAINED[key] = training.train(_processed(spark, sf_dir), task)
    return _TRAINED[key]


@_query
def ml_crime_type_predictions(spark, sf_dir):
    trained = _trained(spark, sf_dir, learning.CRIME_TYPE)
    path = staging_path(spark, "crime-type-predictions")
    table_sink.write_table(training.prediction_table(trained, learning.CRIME_TYPE), path)
    return spark.read.parquet(path).drop("probability")


@_query
def ml_domestic_predictions(spark, sf_dir):
    trained = _trained(spark, sf_dir, learning.DOMESTIC)
    path = staging_path(spark, "domestic-predictions")
    table_sink.write_table(training.prediction_table(trained, learning.DOMESTIC), path)
    return spark.read.parquet(path).drop("probability")


@_query
def ml_test_rows(spark, sf_dir):
    """Which rows are scored, and their truth: what does not depend on the forest."""
    rows = training.test_rows(_processed(spark, sf_dir), learning.CRIME_TYPE)
    return rows.select("ID", "crime_category")


@_query
def ml_label_index(spark, sf_dir):
    labels = _trained(spark, sf_dir, learning.CRIME_TYPE).labels
    return spark.createDataFrame(list(enumerate(labels)), "position bigint, label string")


@_query
def ml_run_counts(spark, sf_dir):
    run = _trained(spark, sf_dir, learning.CRIME_TYPE).run
    return run.select("model_type", "task_type", "label_col", "training_records", "test_records", "sample_fraction")


@_query
def ml_candidates(spark, sf_dir):
    trained = _trained(spark, sf_dir, learning.CRIME_TYPE)
    return training.candidate_table(trained).select("ID", "predicted_crime_category", "top3_candidates")


@_query
def ml_run_document(spark, sf_dir):
    path = staging_path(spark, "runs")
    for task in (learning.CRIME_TYPE, learning.DOMESTIC):
        table_sink.append_run(_trained(spark, sf_dir, task).run, path)
    return runs.read_runs(spark, path).select(
        "model_type",
        "task_type",
        "label_col",
        F.array_join("label_classes", ", ").alias("label_classes"),
        "created_at",
        "metrics.*",
        "training_records",
        "test_records",
        F.size("feature_importance").alias("features"),
        "sample_fraction",
    )


@_query
def feature_importance(spark, sf_dir):
    trained = _trained(spark, sf_dir, learning.DOMESTIC)
    return model_reports.top_features(trained.run)


# ---- model output ----


def _predictions(spark, sf_dir):
    return derive.derived_predictions(_processed(spark, sf_dir))


@_query
def class_distribution(spark, sf_dir):
    return model_reports.class_distribution(
        _predictions(spark, sf_dir), "crime_category", "predicted_crime_category"
    )


def _domestic_confusion(spark, sf_dir):
    judged = _predictions(spark, sf_dir).withColumn("label", F.col("is_domestic_incident").cast("double"))
    return judged, model_reports.confusion_counts(judged, "label", "predicted_is_domestic")


@_query
def confusion_matrix(spark, sf_dir):
    _, counts = _domestic_confusion(spark, sf_dir)
    return model_reports.confusion_matrix(counts, [0.0, 1.0])


@_query
def confusion_matrix_crime_type(spark, sf_dir):
    counts = model_reports.confusion_counts(
        _predictions(spark, sf_dir), "crime_category", "predicted_crime_category"
    )
    return model_reports.confusion_matrix(counts, derive.CRIME_CLASSES)


@_query
def probability_histogram(spark, sf_dir):
    return model_reports.probability_histogram(_predictions(spark, sf_dir))


@_query
def probability_sample(spark, sf_dir):
    return model_reports.sample_probabilities(_predictions(spark, sf_dir))


@_query
def model_metrics(spark, sf_dir):
    judged, _ = _domestic_confusion(spark, sf_dir)
    # three columns, written once and read by both scores
    judged = staged(judged.select("label", "predicted_is_domestic", "prob_domestic"), "judged")
    counts = model_reports.confusion_counts(judged, "label", "predicted_is_domestic")
    auc = model_reports.area_under_roc(judged.dropna(subset=["label"]), "label", "prob_domestic")
    scores = model_reports.quality_scores(counts).withColumn("auc", F.lit(auc))
    return scores.select(*[F.round(c, 9).alias(c) for c in model_reports.METRICS])


@_query
def model_metrics_exact(spark, sf_dir):
    """The area under the curve where nearly every record has a score of its own."""
    number = F.col("ID").cast("bigint")
    score = (number * 7919 % 65521) / F.lit(65521.0)
    label = F.col("is_domestic_incident").cast("double")
    scored = staged(_processed(spark, sf_dir).select(label.alias("label"), score.alias("score")), "scored")
    auc = model_reports.area_under_roc(scored, "label", "score")
    return scored.agg(F.count_distinct("score").alias("scores"), F.round(F.lit(auc), 9).alias("auc"))


@_query
def top3_candidates(spark, sf_dir):
    number = F.col("ID").cast("bigint")
    probabilities = F.array(*[(number + 3) * (i + 2) % 17 / F.lit(16.0) for i in range(5)])
    names = ["first", "second", "third"]
    top = learning.top_candidates(probabilities, derive.CRIME_CLASSES)
    return (
        _processed(spark, sf_dir)
        .select("ID", top.alias("top"))
        .select("ID", *[F.element_at("top", i + 1).alias(name) for i, name in enumerate(names)])
    )


def _run_documents(spark, sf_dir):
    """Run documents derived from the events, two per day; shares of rows stand for scores."""
    rows = derive.events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    hours = rows.groupBy("day", F.hour("ts").alias("hour")).agg(
        F.max("ts").alias("last"),
        F.count("*").alias("n"),
        F.count_if(F.col("value") >= 50).alias("high"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("user_id") % 2 == 0).alias("even"),
    )
    days = hours.groupBy("day").agg(
        F.max("last").alias("last"),
        *[F.sum(c).alias(c) for c in ("n", "high", "views", "even")],
        F.collect_list(F.struct(F.concat(F.lit("hour_"), "hour").alias("feature"), "n")).alias("hours"),
    )
    domestic = F.col("task_type") == learning.DOMESTIC.name
    metrics = F.struct(
        (F.col("high") / F.col("n")).alias("accuracy"),
        (F.col("views") / F.col("n")).alias("f1"),
        F.when(domestic, F.col("even") / F.col("n")).alias("auc"),
    )
    importance = F.transform(
        "hours", lambda h: F.struct(h["feature"].alias("feature"), (h["n"] / F.col("n")).alias("importance"))
    )
    tasks = F.array(*[F.lit(task.name) for task in (learning.DOMESTIC, learning.CRIME_TYPE)])
    documents = days.withColumn("task_type", F.explode(tasks)).select(
        F.lit("RandomForestClassifier").alias("model_type"),
        "task_type",
        F.when(domestic, learning.DOMESTIC.target).otherwise(learning.CRIME_TYPE.target).alias("label_col"),
        F.array(F.lit("a"), F.lit("b")).alias("label_classes"),
        F.date_format("last", times.ISO_FORMAT).alias("created_at"),
        metrics.alias("metrics"),
        F.col("n").alias("training_records"),
        F.lit(0).cast("bigint").alias("test_records"),
        importance.alias("feature_importance"),
        F.lit(learning.SAMPLE_FRACTION).alias("sample_fraction"),
        F.array().cast("array<string>").alias("dropped_features"),
    )
    path = staging_path(spark, "runs")
    table_sink.append_run(documents, path)
    return runs.read_runs(spark, path)


@_query
def latest_runs(spark, sf_dir):
    newest = runs.latest_runs(_run_documents(spark, sf_dir), learning.DOMESTIC.name)
    return newest.select("task_type", "created_at", _plain_time("created_at_ts"), "training_records", "metrics.*")


@_query
def metric_comparison(spark, sf_dir):
    return model_reports.metric_comparison(_run_documents(spark, sf_dir))


@_query
def run_feature_topk(spark, sf_dir):
    newest = runs.latest_run(_run_documents(spark, sf_dir), learning.DOMESTIC.name)
    return model_reports.top_features(newest)
