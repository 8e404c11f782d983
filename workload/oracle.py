"""SQL twins of the registered queries, for DuckDB over the same ``events`` table."""

import re

from workload import rules
from workload.derive import CRIME_CLASSES, LOCATIONS, PRIMARY_TYPES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in values)


def _place_case() -> str:
    branches = "\n".join(
        f"      WHEN regexp_matches(upper(\"Location Description\"), {_text('|'.join(rules.words(words)))}) THEN {_text(category)}"
        for category, words in rules.PLACE_WORDS.items()
    )
    return f"CASE\n{branches}\n      ELSE 'Other' END"


def _crime_case() -> str:
    branches = "\n".join(
        f'      WHEN upper("Primary Type") IN ({_list(rules.words(types))}) THEN {_text(category)}'
        for category, types in rules.CRIME_TYPES.items()
    )
    return f"CASE\n{branches}\n      ELSE 'Other Crime' END"


_MEDIUM = [
    word
    for text in (rules.CRIME_TYPES["Violent Crime"], rules.CRIME_TYPES["Drug/Weapon Crime"], rules.MEDIUM_SEVERITY)
    for word in rules.words(text)
]

# The raw table of workload.derive.
RAW = f"""
moved AS (SELECT *, ts + to_months(CAST(event_id % 30 AS INTEGER)) AS t FROM events),
raw AS (
  SELECT
    event_id,
    CAST(CASE WHEN event_id % 20 = 19 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS "ID",
    'C' || event_id AS "Case Number",
    CASE WHEN event_id % 97 = 5 THEN 'n/a'
         WHEN event_id % 3 = 0 THEN strftime(t, '%m/%d/%Y %I:%M:%S %p')
         WHEN event_id % 3 = 1 THEN strftime(t, '%Y-%m-%dT%H:%M:%S') || '.000'
         ELSE strftime(t, '%Y-%m-%dT%H:%M:%S') END AS "Date",
    CAST(NULL AS VARCHAR) AS "Block",
    CAST(NULL AS VARCHAR) AS "IUCR",
    CASE WHEN event_id % 101 <> 7 THEN list_extract([{_list(PRIMARY_TYPES)}], event_id % 14 + 1) END AS "Primary Type",
    event_type AS "Description",
    CASE WHEN event_id % 53 <> 3
         THEN list_extract([{_list(LOCATIONS)}], (event_id * 7 + user_id) % 24 + 1) END AS "Location Description",
    CASE WHEN event_id % 41 = 4 THEN NULL
         WHEN event_type = 'purchase' THEN 'true'
         WHEN event_type = 'error' THEN 'TRUE'
         WHEN event_id % 43 = 2 THEN 'maybe'
         ELSE 'false' END AS "Arrest",
    CASE WHEN event_id % 37 = 6 THEN NULL WHEN user_id % 5 = 0 THEN 'true' ELSE 'False' END AS "Domestic",
    CAST(NULL AS VARCHAR) AS "Beat",
    CASE WHEN user_id % 29 = 28 THEN NULL
         WHEN event_id % 47 = 0 THEN ''
         WHEN event_id % 2 = 0 THEN lpad(CAST(user_id % 25 + 1 AS VARCHAR), 3, '0')
         ELSE (user_id % 25 + 1) || '.0' END AS "District",
    CAST(NULL AS VARCHAR) AS "Ward",
    CASE WHEN user_id % 31 <> 30 THEN CAST(user_id % 77 + 1 AS VARCHAR) END AS "Community Area",
    CAST(NULL AS VARCHAR) AS "FBI Code",
    CAST(NULL AS VARCHAR) AS "X Coordinate",
    CAST(NULL AS VARCHAR) AS "Y Coordinate",
    CAST(year(t) AS VARCHAR) AS "Year",
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000' AS "Updated On",
    CASE WHEN event_id % 67 <> 8 THEN '41.' || (600 + event_id % 400) END AS "Latitude",
    CASE WHEN event_id % 67 <> 8 THEN '-87.' || (500 + user_id % 150 * 3) END AS "Longitude",
    CAST(NULL AS VARCHAR) AS "Location"
  FROM moved
)"""

CLEAN = (
    RAW
    + """,
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY "ID"
      ORDER BY try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g') DESC NULLS LAST, "Case Number" DESC) AS rn
  FROM raw
  WHERE "ID" IS NOT NULL AND "Date" IS NOT NULL AND "Primary Type" IS NOT NULL AND "Year" IS NOT NULL
),
latest AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1),
clean AS (
  SELECT * REPLACE (
    CAST(NULL AS INTEGER) AS "Beat",
    CAST(NULL AS INTEGER) AS "Ward",
    TRY_CAST(split_part("District", '.', 1) AS INTEGER) AS "District",
    TRY_CAST("Community Area" AS INTEGER) AS "Community Area",
    TRY_CAST("Year" AS INTEGER) AS "Year",
    CAST(NULL AS DOUBLE) AS "X Coordinate",
    CAST(NULL AS DOUBLE) AS "Y Coordinate",
    TRY_CAST("Latitude" AS DOUBLE) AS "Latitude",
    TRY_CAST("Longitude" AS DOUBLE) AS "Longitude",
    CASE lower("Arrest") WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS "Arrest",
    CASE lower("Domestic") WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS "Domestic")
  FROM latest
)"""
)

PROCESSED = (
    CLEAN
    + f""",
timed AS (
  SELECT * EXCLUDE ("Year"),
    coalesce(try_strptime("Date", '%m/%d/%Y %I:%M:%S %p'),
             try_strptime("Date", '%Y-%m-%dT%H:%M:%S.%g'),
             try_strptime("Date", '%Y-%m-%dT%H:%M:%S')) AS crime_datetime
  FROM clean
),
parts AS (
  SELECT *,
    CAST(year(crime_datetime) AS INTEGER) AS "Year",
    CAST(year(crime_datetime) AS INTEGER) AS crime_year,
    CAST(month(crime_datetime) AS INTEGER) AS crime_month,
    CAST(day(crime_datetime) AS INTEGER) AS crime_day,
    CAST(hour(crime_datetime) AS INTEGER) AS crime_hour,
    CAST(dayofweek(crime_datetime) + 1 AS INTEGER) AS crime_day_of_week
  FROM timed WHERE crime_datetime IS NOT NULL
),
featured AS (
  SELECT *,
    CASE WHEN crime_hour BETWEEN 5 AND 11 THEN 'MORNING' WHEN crime_hour BETWEEN 12 AND 16 THEN 'AFTERNOON'
         WHEN crime_hour BETWEEN 17 AND 21 THEN 'EVENING' ELSE 'NIGHT' END AS time_of_day,
    CASE WHEN crime_month IN (12, 1, 2) THEN 'WINTER' WHEN crime_month IN (3, 4, 5) THEN 'SPRING'
         WHEN crime_month IN (6, 7, 8) THEN 'SUMMER' ELSE 'FALL' END AS season,
    {_place_case()} AS location_category,
    {_crime_case()} AS crime_category,
    CASE WHEN upper("Primary Type") IN ({_list(rules.words(rules.HIGH_SEVERITY))}) THEN 3
         WHEN upper("Primary Type") IN ({_list(_MEDIUM)}) THEN 2 ELSE 1 END AS severity,
    crime_hour >= 22 OR crime_hour < 4 AS is_night,
    "Arrest" AS was_arrest_made,
    "Domestic" AS is_domestic_incident
  FROM parts
),
scored AS (
  SELECT *,
    'Level ' || severity AS crime_severity_level,
    CAST(CASE severity WHEN 3 THEN 10 WHEN 2 THEN 3 ELSE 1 END AS DOUBLE) AS crime_severity_weight,
    CAST(CASE WHEN location_category IN ({_list(rules.PUBLIC_PLACES)}) THEN 3
              WHEN location_category = 'Other' THEN 1 ELSE 2 END AS DOUBLE) AS location_risk_weight,
    crime_category = 'Violent Crime' AS is_violent,
    location_category IN ({_list(rules.PUBLIC_PLACES)}) AS is_public_space
  FROM featured
),
processed AS (
  SELECT *,
    greatest(1.0::DOUBLE, least(10.0::DOUBLE, 1.0::DOUBLE + (
        crime_severity_weight + location_risk_weight
        + CASE WHEN is_night THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END
        + CASE WHEN is_domestic_incident THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END
        + CASE WHEN is_public_space THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
        - 2.0::DOUBLE) * (9.0::DOUBLE / 15.5::DOUBLE))) AS risk_score
  FROM scored
)"""
)

# Records of the change source: some have no change time.
CHANGES = (
    RAW
    + """,
source AS (
  SELECT * REPLACE (CASE WHEN event_id % 59 <> 9 THEN "Updated On" END AS "Updated On") FROM raw
),
keyed AS (
  SELECT *, try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g') AS u, TRY_CAST("ID" AS BIGINT) AS n FROM source
),
middle AS (
  SELECT to_timestamp((epoch(min(u))::BIGINT + epoch(max(u))::BIGINT) // 2) AT TIME ZONE 'UTC' AS m FROM keyed
),
cur AS (SELECT u AS cu, n AS cn FROM keyed, middle WHERE u <= m ORDER BY u DESC, n DESC LIMIT 1)"""
)


def _fraction(draw: int) -> str:
    return f"CAST('0x' || substr(md5('42:' || \"ID\"), {1 + 8 * draw}, 8) AS BIGINT) / 4294967296.0"


# Feature frame of the crime-type task, its sample, and the sample with collapsed locations.
FRAME = (
    PROCESSED
    + """,
frame AS (
  SELECT "ID", crime_datetime, "Location Description", location_category, crime_category,
    crime_hour, crime_day_of_week, crime_month, time_of_day, season, location_risk_weight,
    coalesce("Latitude", 0.0) AS "Latitude", coalesce("Longitude", 0.0) AS "Longitude",
    CAST(is_night AS DOUBLE) AS is_night,
    coalesce(CAST(is_domestic_incident AS DOUBLE), 0.0) AS is_domestic_incident,
    CAST(is_public_space AS DOUBLE) AS is_public_space,
    CAST("District" AS DOUBLE) AS "District",
    coalesce(CAST("Community Area" AS DOUBLE), 0.0) AS "Community_Area",
    CAST(CAST("District" AS DOUBLE) AS VARCHAR) AS "District_str",
    CASE WHEN crime_day_of_week = 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
    CASE WHEN crime_hour BETWEEN 8 AND 18 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_work_hour
  FROM processed
  WHERE "District" IS NOT NULL
)"""
)

SAMPLE = (
    FRAME
    + f""",
sampled AS (SELECT * FROM frame WHERE {_fraction(0)} < 0.7),
top20 AS (
  SELECT "Location Description", count(*) AS n FROM sampled GROUP BY 1
  ORDER BY n DESC, "Location Description" ASC NULLS LAST LIMIT {rules.TOP_LOCATIONS}
),
collapsed AS (
  SELECT s.*, coalesce(k."Location Description", 'OTHER') AS "loc_desc_topN"
  FROM sampled s LEFT JOIN top20 k ON s."Location Description" = k."Location Description"
)"""
)

PREDICTIONS = (
    PROCESSED
    + f""",
predictions AS (
  SELECT "ID", crime_category, is_domestic_incident,
    (CAST("ID" AS BIGINT) * 37 % 101) / 100.0::DOUBLE AS prob_domestic,
    CAST((CAST("ID" AS BIGINT) * 37 % 101) / 100.0::DOUBLE >= 0.5 AS DOUBLE) AS predicted_is_domestic,
    list_extract([{_list(CRIME_CLASSES)}], CAST("ID" AS BIGINT) % 5 + 1) AS predicted_crime_category
  FROM processed
)"""
)

RUNS = """
daily AS (
  SELECT CAST(ts AS DATE) AS day, max(ts) AS last, count(*) AS n,
    count(*) FILTER (value >= 50) AS high, count(*) FILTER (event_type = 'view') AS views,
    count(*) FILTER (user_id % 2 = 0) AS even
  FROM events GROUP BY 1
),
runs AS (
  SELECT strftime(last, '%Y-%m-%dT%H:%M:%S') AS created_at, date_trunc('second', last) AS created_at_ts, day, n,
    task.task_type, high / n AS accuracy, views / n AS f1,
    CASE WHEN task.task_type = 'domestic_incident_prediction' THEN even / n END AS auc
  FROM daily, (VALUES ('domestic_incident_prediction'), ('crime_type_prediction')) AS task(task_type)
)"""

AREAS = (
    PROCESSED
    + """,
areas AS (
  SELECT "Community Area" AS community_area, count(*) AS crime_count FROM processed
  WHERE "Community Area" IS NOT NULL GROUP BY 1
),
quantiles AS (
  SELECT quantile_cont(crime_count, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q,
    CAST(min(crime_count) AS BIGINT) AS mn, CAST(max(crime_count) AS BIGINT) AS mx FROM areas
),
rounded AS (
  SELECT list_sort(list_distinct([CAST(round_even(x, 0) AS BIGINT) FOR x IN q])) AS edges, mn, mx,
    greatest(1, CAST(trunc((mx - mn) / 5) AS BIGINT)) AS step
  FROM quantiles
),
classes AS (
  SELECT CASE WHEN len(edges) < 3 THEN [mn, mn + step, mn + 2 * step, mn + 3 * step, mn + 4 * step, mx]
              ELSE edges END AS edges
  FROM rounded
)"""
)

# Raw rows as they come out of the message stream.
INGESTED = (
    RAW
    + """,
sent AS (
  SELECT *, event_id % 89 = 1 OR event_id % 83 = 2 AS lost, event_id % 2 = 0 AS api FROM raw
),
ingested AS (
  SELECT
    CASE WHEN NOT lost THEN "ID" END AS "ID",
    CASE WHEN NOT lost THEN "Case Number" END AS "Case Number",
    CASE WHEN NOT lost THEN "Date" END AS "Date",
    CAST(NULL AS VARCHAR) AS "Block",
    CAST(NULL AS VARCHAR) AS "IUCR",
    CASE WHEN NOT lost THEN "Primary Type" END AS "Primary Type",
    CASE WHEN NOT lost THEN "Description" END AS "Description",
    CASE WHEN NOT lost THEN "Location Description" END AS "Location Description",
    CASE WHEN NOT lost THEN CASE WHEN api THEN lower("Arrest") ELSE "Arrest" END END AS "Arrest",
    CASE WHEN NOT lost THEN "Domestic" END AS "Domestic",
    CAST(NULL AS VARCHAR) AS "Beat",
    CASE WHEN NOT lost THEN "District" END AS "District",
    CAST(NULL AS VARCHAR) AS "Ward",
    CASE WHEN NOT lost THEN "Community Area" END AS "Community Area",
    CAST(NULL AS VARCHAR) AS "FBI Code",
    CAST(NULL AS VARCHAR) AS "X Coordinate",
    CAST(NULL AS VARCHAR) AS "Y Coordinate",
    CASE WHEN NOT lost THEN "Year" END AS "Year",
    CASE WHEN NOT lost THEN "Updated On" END AS "Updated On",
    CASE WHEN NOT lost THEN "Latitude" END AS "Latitude",
    CASE WHEN NOT lost THEN "Longitude" END AS "Longitude",
    CASE WHEN NOT lost AND api AND "Latitude" IS NOT NULL
         THEN '{"latitude":"' || "Latitude" || '","longitude":"' || "Longitude" || '"}' END AS "Location"
  FROM sent
)"""
)

_PROCESSED_COLUMNS = """"ID", "Case Number", "Date", "Primary Type", "Description", "Location Description",
  "Arrest", "Domestic", "Beat", "District", "Ward", "Community Area", "Year", "Latitude", "Longitude",
  crime_datetime, crime_year, crime_month, crime_day, crime_hour, crime_day_of_week, time_of_day, season,
  location_category, location_risk_weight, crime_category, crime_severity_level, crime_severity_weight,
  is_violent, is_night, was_arrest_made, is_domestic_incident, is_public_space, risk_score"""

_NIGHT_RISK = """
  SELECT "District", count(*) AS total_crimes, CAST(sum(CAST({night} AS INTEGER)) AS BIGINT) AS night_crimes,
    avg(CAST("Arrest" AS INTEGER)) AS arrest_rate,
    sum(CAST({night} AS INTEGER)) / count(*) AS night_crime_ratio
  FROM processed WHERE "District" IS NOT NULL GROUP BY 1"""

_WEEKDAY = "list_extract(['Sun','Mon','Tue','Wed','Thu','Fri','Sat'], dayofweek({t}) + 1)"
_CSV_TIME = "try_strptime(\"Date\", '%m/%d/%Y %I:%M:%S %p')"

_MATRIX_COLUMNS = ",\n    ".join(
    f"CAST(nullif(count(*) FILTER (crime_hour = {h}), 0) AS BIGINT) AS h{h:02d}" for h in range(24)
)


# Records whose change time is cut to the hour, some without a numeric ID: many ties.
TIED = CHANGES.replace('"Updated On" END AS "Updated On") FROM raw', """substr("Updated On", 1, 13) || ':00:00.000' END AS "Updated On",
    CASE WHEN event_id % 50 = 0 THEN 'x' || (event_id % 7) ELSE "ID" END AS "ID") FROM raw""")

# The same with missing IDs, those of the last hour all.
TIED_MISSING = TIED.replace(
    "keyed AS (",
    """untold AS (
  SELECT * REPLACE (CASE WHEN event_id % 40 <> 3 AND "Updated On" IS DISTINCT FROM (SELECT max("Updated On") FROM source)
                         THEN "ID" END AS "ID") FROM source
),
keyed AS (""",
).replace("AS n FROM source", "AS n FROM untold")

LARGE_AREAS = AREAS.replace("count(*) AS crime_count", "count(*) * 1000000000 AS crime_count")

# Every record twice, once without its flag and both without a change time, so only the last resort tells them apart.
_RAW_NAMES = sorted(["ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description", "Location Description",
                     "Arrest", "Domestic", "Beat", "District", "Ward", "Community Area", "FBI Code", "X Coordinate",
                     "Y Coordinate", "Year", "Updated On", "Latitude", "Longitude", "Location"])
_DIGEST = "sha256(" + " || chr(1) || ".join(f"""coalesce('=' || CAST("{c}" AS VARCHAR), '')""" for c in _RAW_NAMES) + ")"


def _second_delivery() -> str:
    """The steps from ranked to processed for the other records, under names of their own."""
    steps = PROCESSED[PROCESSED.index("ranked AS (") :]
    steps = steps.replace("FROM raw\n  WHERE", "FROM raw\n  WHERE event_id % 10 = 9 AND")
    for name in ("ranked", "latest", "clean", "timed", "parts", "featured", "scored", "processed"):
        steps = steps.replace(f"{name} AS (", f"{name}_2 AS (")
        steps = re.sub(rf"FROM {name}\b", f"FROM {name}_2", steps)
    return steps


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


_ALL_MESSAGE_ROWS = 'SELECT * FROM ingested'
_AFTER_CURSOR = 'SELECT "ID", "Case Number", "Updated On" FROM keyed, cur WHERE u > cu OR (u = cu AND n > cn)'


def statements() -> dict[str, str]:
    return {
        # cleaning
        "clean_incidents": _with(CLEAN, "SELECT * EXCLUDE (event_id) FROM clean"),
        "dedup_latest": _with(CLEAN, 'SELECT "ID", "Case Number", "Updated On" FROM latest'),
        "clean_missing_columns": _with(
            PROCESSED,
            """SELECT "ID", FALSE AS was_arrest_made, FALSE AS is_domestic_incident,
                 greatest(1.0::DOUBLE, least(10.0::DOUBLE, 1.0::DOUBLE + (crime_severity_weight + location_risk_weight
                   + CASE WHEN is_night THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END
                   + CASE WHEN is_public_space THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
                   - 2.0::DOUBLE) * (9.0::DOUBLE / 15.5::DOUBLE))) AS risk_score
               FROM processed""",
        ),
        # features
        "time_features": _with(
            PROCESSED,
            """SELECT "ID", crime_datetime, "Year", crime_year, crime_month, crime_day, crime_hour,
                 crime_day_of_week, time_of_day, season FROM processed""",
        ),
        "parse_updated_on": """SELECT event_id,
            CASE event_id % 8 WHEN 7 THEN NULL WHEN 2 THEN ts WHEN 3 THEN date_trunc('millisecond', ts)
                 ELSE date_trunc('second', ts) END AS changed_at FROM events""",
        "location_category": _with(
            PROCESSED, 'SELECT "Location Description", location_category, count(*) AS n FROM processed GROUP BY 1, 2'
        ),
        "crime_features": _with(
            PROCESSED,
            """SELECT "ID", location_category, location_risk_weight, crime_category, crime_severity_level,
                 crime_severity_weight, is_violent, is_night, was_arrest_made, is_domestic_incident,
                 is_public_space FROM processed""",
        ),
        "risk_score": _with(PROCESSED, 'SELECT "ID", risk_score FROM processed'),
        "processed_roundtrip": _with(PROCESSED, f"SELECT {_PROCESSED_COLUMNS} FROM processed"),
        "etl_row_counts": _with(
            PROCESSED,
            "SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM processed) AS processed_rows",
        ),
        # trends
        "yearly_trend": _with(PROCESSED, 'SELECT "Year", count(*) AS crime_count FROM processed GROUP BY 1'),
        "type_counts": _with(PROCESSED, 'SELECT "Primary Type", count(*) AS crime_count FROM processed GROUP BY 1'),
        "top20_types": _with(
            PROCESSED,
            'SELECT "Primary Type", count(*) AS crime_count FROM processed GROUP BY 1'
            ' ORDER BY crime_count DESC, "Primary Type" LIMIT 20',
        ),
        "hourly_by_day_type": _with(
            PROCESSED,
            """SELECT crime_hour, CASE WHEN crime_day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
                 count(*) AS crime_count FROM processed GROUP BY 1, 2""",
        ),
        "arrest_rate_top20": _with(
            PROCESSED,
            """SELECT "Primary Type", count(*) AS total_crimes, count(*) FILTER (was_arrest_made) AS arrests,
                 count(*) FILTER (was_arrest_made) / count(*) * 100 AS arrest_rate
               FROM processed GROUP BY 1 ORDER BY arrest_rate DESC, "Primary Type" LIMIT 20""",
        ),
        "district_stats": _with(
            PROCESSED,
            """SELECT "District", count(*) AS crime_count,
                 avg(CASE WHEN was_arrest_made THEN 1 ELSE 0 END) AS arrest_rate FROM processed GROUP BY 1""",
        ),
        "night_risk_by_district": _with(PROCESSED, _NIGHT_RISK.format(night="is_night")),
        "night_risk_by_district_wide": _with(
            PROCESSED, _NIGHT_RISK.format(night="(crime_hour >= 22 OR crime_hour < 6)")
        ),
        "night_risk_quadrants": _with(
            PROCESSED + f",\nd AS ({_NIGHT_RISK.format(night='is_night')}),\n"
            "a AS (SELECT avg(night_crime_ratio) AS avg_night, avg(arrest_rate) AS avg_arrest FROM d)",
            """SELECT "District", total_crimes, night_crimes, arrest_rate, night_crime_ratio,
                 round(avg_night, 9) AS avg_night, round(avg_arrest, 9) AS avg_arrest,
                 CASE WHEN night_crime_ratio >= avg_night THEN 'high night' ELSE 'low night' END || ', ' ||
                 CASE WHEN arrest_rate >= avg_arrest THEN 'high arrest' ELSE 'low arrest' END AS quadrant
               FROM d, a""",
        ),
        "weekday_hour_counts": _with(
            PROCESSED,
            f"""SELECT {_WEEKDAY.format(t='crime_datetime')} AS weekday, crime_hour AS hour, count(*) AS crime_count
                FROM processed GROUP BY 1, 2""",
        ),
        "weekday_hour_counts_strict": _with(
            PROCESSED,
            f"""SELECT {_WEEKDAY.format(t=_CSV_TIME)} AS weekday, CAST(hour({_CSV_TIME}) AS INTEGER) AS hour,
                  count(*) AS crime_count FROM processed GROUP BY 1, 2""",
        ),
        "weekday_hour_matrix": _with(
            PROCESSED,
            f"""SELECT {_WEEKDAY.format(t='crime_datetime')} AS weekday,
    {_MATRIX_COLUMNS}
  FROM processed GROUP BY 1""",
        ),
        "row_counts": _with(
            PROCESSED,
            "SELECT (SELECT count(*) FROM processed) AS processed_rows, (SELECT count(*) FROM raw) AS raw_rows",
        ),
        "result_table_replace": _with(
            PROCESSED, 'SELECT "Year", count(*) AS crime_count FROM processed GROUP BY 1'
        ),
        "collection_crime_by_year": _with(
            PROCESSED, 'SELECT "Year", count(*) AS crime_count FROM processed GROUP BY 1'
        ),
        "collection_hourly_patterns": _with(
            PROCESSED,
            """SELECT crime_hour, CASE WHEN crime_day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
                 count(*) AS crime_count FROM processed GROUP BY 1, 2""",
        ),
        "collection_arrest_rates": _with(
            PROCESSED,
            """SELECT "Primary Type", count(*) AS total_crimes, count(*) FILTER (was_arrest_made) AS arrests,
                 count(*) FILTER (was_arrest_made) / count(*) * 100 AS arrest_rate
               FROM processed GROUP BY 1 ORDER BY arrest_rate DESC, "Primary Type" LIMIT 20""",
        ),
        "collection_district_analysis": _with(
            PROCESSED,
            """SELECT "District", count(*) AS crime_count,
                 avg(CASE WHEN was_arrest_made THEN 1 ELSE 0 END) AS arrest_rate FROM processed GROUP BY 1""",
        ),
        # the first delivery cleaned by itself, then the second over it
        "processed_upsert": _with(
            PROCESSED.replace("FROM raw\n  WHERE", "FROM raw\n  WHERE event_id % 10 <> 9 AND")
            + ",\nfirst AS (SELECT * FROM processed),\n"
            + _second_delivery(),
            """SELECT "ID", "Case Number", "Year", crime_category, risk_score FROM first
               WHERE "ID" NOT IN (SELECT "ID" FROM processed_2)
               UNION ALL SELECT "ID", "Case Number", "Year", crime_category, risk_score FROM processed_2""",
        ),
        # areas
        "community_area_counts": _with(AREAS, "SELECT * FROM areas"),
        "area_counts_on_boundaries": _with(
            AREAS
            + """,
boundaries AS (
  SELECT DISTINCT CAST(user_id % 77 + 1 AS VARCHAR) AS area_numbe FROM events
  UNION ALL SELECT unnest(['78', 'abc', NULL])
)""",
            """SELECT area_numbe, coalesce('AREA ' || area_numbe, 'NO AREA') AS community,
                 coalesce(crime_count, 0) AS crime_count
               FROM boundaries LEFT JOIN areas ON TRY_CAST(area_numbe AS INTEGER) = community_area""",
        ),
        "area_counts_on_numbered_boundaries": _with(
            AREAS + ", known AS (SELECT DISTINCT user_id % 77 + 1 AS area FROM events)",
            """SELECT CAST(area AS BIGINT) AS area, CASE WHEN area % 3 = 2 THEN 0 ELSE coalesce(crime_count, 0) END AS crime_count
               FROM known LEFT JOIN areas ON area = community_area""",
        ),
        "choropleth_bins": _with(
            AREAS, "SELECT CAST(generate_subscripts(edges, 1) - 1 AS INTEGER) AS position, unnest(edges) AS edge FROM classes"
        ),
        "choropleth_bins_large": _with(
            LARGE_AREAS,
            "SELECT CAST(generate_subscripts(edges, 1) - 1 AS INTEGER) AS position, unnest(edges) AS edge FROM classes",
        ),
        "choropleth_classes": _with(
            AREAS,
            """SELECT community_area, crime_count, CAST(greatest(1, least(len(list_distinct(edges)) - 1,
                 len([e FOR e IN list_distinct(edges) IF e <= crime_count]))) AS INTEGER) AS class_no
               FROM areas, classes""",
        ),
        "heat_grid": _with(
            PROCESSED,
            """SELECT CAST(floor("Latitude" / 0.01::DOUBLE) AS BIGINT) AS lat_cell,
                 CAST(floor("Longitude" / 0.01::DOUBLE) AS BIGINT) AS lon_cell, count(*) AS crime_count
               FROM processed WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL GROUP BY 1, 2""",
        ),
        "heat_density": _with(
            PROCESSED
            + """,
kernel AS (
  SELECT y, x, CAST(floor(1000 * least(1.0::DOUBLE, (7 - sqrt(y * y + x * x)) / 4)) AS BIGINT) AS w
  FROM range(-7, 8) AS a(y), range(-7, 8) AS b(x) WHERE sqrt(y * y + x * x) < 7
),
fine AS (
  SELECT CAST(floor("Latitude" / 0.01::DOUBLE) AS BIGINT) AS a, CAST(floor("Longitude" / 0.01::DOUBLE) AS BIGINT) AS b,
    count(*) AS n
  FROM processed WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL GROUP BY 1, 2
),
cells AS (
  SELECT zoom, CAST(floor(a / (2 ** zoom)) AS BIGINT) AS a, CAST(floor(b / (2 ** zoom)) AS BIGINT) AS b, sum(n) AS n
  FROM fine, (VALUES (0), (1), (2)) AS levels(zoom) GROUP BY 1, 2, 3
)""",
            """SELECT zoom, a + y AS lat_cell, b + x AS lon_cell, CAST(sum(n * w) AS BIGINT) / 1000 AS density
               FROM cells, kernel WHERE w > 0 GROUP BY 1, 2, 3""",
        ),
        "coordinate_sample": _with(
            PROCESSED,
            f"""SELECT "Latitude", "Longitude" FROM processed
                WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND {_fraction(0)} < 0.01""",
        ),
        # messages and quality
        "stream_ingest": _with(INGESTED, _ALL_MESSAGE_ROWS),
        "stream_restart": _with(INGESTED, _ALL_MESSAGE_ROWS),
        "publish_messages": _with(
            RAW,
            """SELECT "ID" AS key, CAST(to_json(struct_pack("ID" := "ID", "Case Number" := "Case Number", "Date" := "Date",
                 "Block" := "Block", "IUCR" := "IUCR", "Primary Type" := "Primary Type",
                 "Description" := "Description", "Location Description" := "Location Description",
                 "Arrest" := "Arrest", "Domestic" := "Domestic", "Beat" := "Beat", "District" := "District",
                 "Ward" := "Ward", "Community Area" := "Community Area", "FBI Code" := "FBI Code",
                 "X Coordinate" := "X Coordinate", "Y Coordinate" := "Y Coordinate", "Year" := "Year",
                 "Updated On" := "Updated On", "Latitude" := "Latitude", "Longitude" := "Longitude",
                 "Location" := "Location")) AS VARCHAR) AS value FROM raw""",
        ),
        "all_null_messages": _with(
            RAW,
            """SELECT CASE WHEN event_id % 89 = 1 THEN 'not json' WHEN event_id % 83 = 2 THEN '' ELSE
                 CAST(to_json(struct_pack("ID" := "ID", "Case Number" := "Case Number", "Date" := "Date",
                 "Block" := "Block", "IUCR" := "IUCR", "Primary Type" := "Primary Type",
                 "Description" := "Description", "Location Description" := "Location Description",
                 "Arrest" := "Arrest", "Domestic" := "Domestic", "Beat" := "Beat", "District" := "District",
                 "Ward" := "Ward", "Community Area" := "Community Area", "FBI Code" := "FBI Code",
                 "X Coordinate" := "X Coordinate", "Y Coordinate" := "Y Coordinate", "Year" := "Year",
                 "Updated On" := "Updated On", "Latitude" := "Latitude", "Longitude" := "Longitude",
                 "Location" := "Location")) AS VARCHAR) END AS json_str
               FROM raw WHERE event_id % 89 = 1 OR event_id % 83 = 2 OR event_id % 2 = 1""",
        ),
        "non_empty_rows": _with(
            INGESTED, 'SELECT "ID", "Case Number", "Date", "Arrest", "Location" FROM ingested WHERE "Case Number" IS NOT NULL'
        ),
        "message_quality": """SELECT count(*) AS total_messages,
            count(*) FILTER (event_id % 89 = 1 OR event_id % 83 = 2 OR event_id % 2 = 1) AS all_null_messages,
            count(*) FILTER (event_id % 89 <> 1 AND event_id % 83 = 2) AS parse_failed,
            count(*) FILTER (event_id % 89 = 1) AS malformed FROM events""",
        "raw_null_profile": """SELECT count(*) AS total_rows,
            count(*) FILTER (event_id % 89 = 1 OR event_id % 83 = 2) AS all_null_rows,
            count(*) FILTER (NOT (event_id % 89 = 1 OR event_id % 83 = 2)) AS not_all_null_rows FROM events""",
        # changes
        "full_load": _with(CHANGES, 'SELECT "ID", "Case Number", "Updated On" FROM keyed WHERE u IS NOT NULL'),
        "incremental_load": _with(CHANGES, _AFTER_CURSOR),
        "incremental_load_typed": _with(
            CHANGES,
            """SELECT "ID", "Case Number", u AS "Updated On" FROM keyed, cur WHERE u > cu OR (u = cu AND n > cn)""",
        ),
        "incremental_lookback": _with(
            CHANGES,
            """SELECT "ID", "Case Number", "Updated On" FROM keyed, cur
               WHERE u > cu - INTERVAL 24 HOUR OR (u = cu - INTERVAL 24 HOUR AND n > 0)""",
        ),
        "keyset_page": _with(CHANGES, f"SELECT \"ID\", \"Updated On\" FROM ({_AFTER_CURSOR}) JOIN "
                             "(SELECT \"Case Number\", u, n FROM keyed) USING (\"Case Number\") ORDER BY u, n LIMIT 1000"),
        "keyset_pages_union": _with(TIED, 'SELECT "ID", "Case Number", "Updated On" FROM keyed WHERE u IS NOT NULL'),
        "keyset_pages_missing_ids": _with(
            TIED_MISSING, 'SELECT "ID", "Case Number", "Updated On" FROM keyed WHERE u IS NOT NULL'
        ),
        "change_stream": _with(TIED_MISSING, 'SELECT "ID", "Case Number", "Updated On" FROM keyed WHERE u IS NOT NULL'),
        "stream_latest": _with(
            INGESTED,
            """SELECT "ID", "Case Number", "Updated On" FROM ingested WHERE "ID" IS NOT NULL AND "Updated On" IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY "ID"
                   ORDER BY try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g') DESC, "Case Number" DESC) = 1""",
        ),
        "csv_bootstrap_limited": _with(
            RAW,
            """SELECT row_number() OVER (ORDER BY encode("Case Number")) AS row_number, "Case Number" AS case_number FROM raw
               QUALIFY row_number <= (SELECT count(*) // 2 FROM raw)""",
        ),
        "dedup_ties": _with(
            RAW
            + f""",
copies AS (
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS "Updated On", unnest([NULL, 'true']) AS "Arrest") FROM raw
  WHERE "ID" IS NOT NULL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "ID"
    ORDER BY "Case Number" DESC NULLS LAST, "Date" DESC NULLS LAST, {_DIGEST}) AS place
  FROM copies
)""",
            'SELECT "ID", "Case Number", "Arrest" FROM ranked WHERE place = 1',
        ),
        "increment_runs_typed": """SELECT count(*) AS messages,
              CASE WHEN max(t) = date_trunc('second', max(t)) THEN strftime(max(t), '%Y-%m-%dT%H:%M:%S')
                   ELSE strftime(max(t), '%Y-%m-%dT%H:%M:%S.%f') END AS last_updated_on,
              CAST(max_by(event_id, (t, event_id)) AS VARCHAR) AS last_id
            FROM (SELECT event_id, ts + to_milliseconds(event_id % 1000) AS t FROM events)""",
        "csv_bootstrap_multiline": _with(
            RAW,
            """SELECT "ID" AS key, "Case Number" AS case_number,
                 'said "' || "Description" || '",' || chr(10) || 'then left' AS description FROM raw""",
        ),
        "csv_bootstrap_two_layouts": _with(
            RAW,
            """SELECT (SELECT count(*) FROM raw) AS rows_sent,
                 strftime(try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g'), '%Y-%m-%dT%H:%M:%S') AS last_updated_on,
                 "ID" AS last_id
               FROM raw ORDER BY try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g') DESC, "ID" DESC LIMIT 1""",
        ),
        "csv_bootstrap_no_id": _with(
            RAW,
            """SELECT (SELECT count(*) FROM raw) AS rows_sent,
                 strftime(max(try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g')), '%Y-%m-%dT%H:%M:%S') AS last_updated_on,
                 '0' AS last_id FROM raw""",
        ),
        "next_cursor": _with(
            CHANGES,
            """SELECT "Updated On" AS last_updated_on, CAST(n AS VARCHAR) AS last_id FROM keyed, cur
               WHERE u > cu OR (u = cu AND n > cn) ORDER BY u DESC, n DESC LIMIT 1""",
        ),
        "csv_bootstrap": _with(
            RAW,
            """SELECT (SELECT count(*) FROM raw) AS rows_sent,
                 strftime(try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g'), '%Y-%m-%dT%H:%M:%S') AS last_updated_on,
                 "ID" AS last_id
               FROM raw ORDER BY try_strptime("Updated On", '%Y-%m-%dT%H:%M:%S.%g') DESC, "ID" DESC LIMIT 1""",
        ),
        "increment_runs": _with(
            CHANGES,
            """SELECT count(*) AS messages, max("Updated On") AS last_updated_on,
                 (SELECT CAST(n AS VARCHAR) FROM keyed WHERE u IS NOT NULL ORDER BY u DESC, n DESC LIMIT 1) AS last_id
               FROM keyed WHERE u IS NOT NULL""",
        ),
        # model input
        "ml_feature_frame": _with(FRAME, "SELECT * FROM frame"),
        "ml_feature_frame_weekends": _with(
            FRAME,
            """SELECT "ID", crime_day_of_week,
                 CASE WHEN crime_day_of_week IN (1, 7) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend FROM frame""",
        ),
        "ml_domestic_frame": _with(
            FRAME.replace("coalesce(CAST(is_domestic_incident AS DOUBLE), 0.0) AS is_domestic", "is_domestic_incident AS is_domestic")
            .replace('WHERE "District" IS NOT NULL', 'WHERE "District" IS NOT NULL AND is_domestic_incident IS NOT NULL'),
            "SELECT * FROM frame",
        ),
        "ml_sample": _with(SAMPLE, 'SELECT "ID" FROM sampled'),
        "ml_split": _with(SAMPLE, f'SELECT "ID", {_fraction(1)} < 0.8 AS is_train FROM sampled'),
        "ml_test_rows": _with(SAMPLE, f'SELECT "ID", crime_category FROM sampled WHERE NOT {_fraction(1)} < 0.8'),
        "ml_label_index": _with(
            SAMPLE,
            f"""SELECT row_number() OVER (ORDER BY count(*) DESC, crime_category) - 1 AS position, crime_category AS label
                FROM sampled WHERE {_fraction(1)} < 0.8 GROUP BY 2""",
        ),
        "ml_run_counts": _with(
            SAMPLE,
            f"""SELECT 'RandomForestClassifier' AS model_type, 'crime_type_prediction' AS task_type,
                  'crime_category' AS label_col, count(*) FILTER ({_fraction(1)} < 0.8) AS training_records,
                  count(*) FILTER (NOT {_fraction(1)} < 0.8) AS test_records, 0.7::DOUBLE AS sample_fraction FROM sampled""",
        ),
        "top_location_descriptions": _with(SAMPLE, "SELECT * FROM top20"),
        "location_topn_collapse": _with(SAMPLE, 'SELECT "ID", "loc_desc_topN" FROM collapsed'),
        "categorical_cardinality": _with(
            SAMPLE,
            """SELECT count(DISTINCT time_of_day) AS time_of_day, count(DISTINCT season) AS season,
                 count(DISTINCT location_category) AS location_category, count(DISTINCT "District_str") AS "District_str",
                 count(DISTINCT "loc_desc_topN") AS "loc_desc_topN" FROM collapsed""",
        ),
        "label_distribution": _with(
            PROCESSED,
            """SELECT CAST(is_domestic_incident AS DOUBLE) AS label, count(*) AS n FROM processed
               WHERE is_domestic_incident IS NOT NULL AND "District" IS NOT NULL GROUP BY 1""",
        ),
        # model output
        "class_distribution": _with(
            PREDICTIONS,
            """SELECT coalesce(t.label, p.label) AS label, coalesce(t.n, 0) AS true_count, coalesce(p.n, 0) AS pred_count
               FROM (SELECT crime_category AS label, count(*) AS n FROM predictions GROUP BY 1) t
               FULL JOIN (SELECT predicted_crime_category AS label, count(*) AS n FROM predictions GROUP BY 1) p
               ON t.label = p.label""",
        ),
        "confusion_matrix": _with(
            PREDICTIONS,
            """SELECT CAST(is_domestic_incident AS DOUBLE) AS label,
                 count(*) FILTER (predicted_is_domestic = 0) AS pred_0,
                 count(*) FILTER (predicted_is_domestic = 1) AS pred_1
               FROM predictions WHERE is_domestic_incident IS NOT NULL GROUP BY 1""",
        ),
        "confusion_matrix_crime_type": _with(
            PREDICTIONS,
            "SELECT crime_category AS label, "
            + ", ".join(
                f"count(*) FILTER (predicted_crime_category = '{c}') AS pred_{i}" for i, c in enumerate(CRIME_CLASSES)
            )
            + " FROM predictions GROUP BY 1",
        ),
        "probability_histogram": _with(
            PREDICTIONS + ",\nb AS (SELECT min(prob_domestic) AS lo, max(prob_domestic) AS hi FROM predictions)",
            """SELECT CAST(least(floor((prob_domestic - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n
               FROM predictions, b GROUP BY 1""",
        ),
        "probability_sample": _with(
            PREDICTIONS, f"SELECT prob_domestic AS prob FROM predictions WHERE {_fraction(0)} < 0.01"
        ),
        "model_metrics": _with(
            PREDICTIONS
            + """,
judged AS (
  SELECT CAST(is_domestic_incident AS INTEGER) AS label, CAST(predicted_is_domestic AS INTEGER) AS pred, prob_domestic AS p
  FROM predictions WHERE is_domestic_incident IS NOT NULL
),
per_class AS (
  SELECT c, count(*) FILTER (label = c) AS truth,
    2.0::DOUBLE * count(*) FILTER (label = c AND pred = c)
      / (count(*) FILTER (label = c) + count(*) FILTER (pred = c)) AS f1
  FROM judged, (VALUES (0), (1)) AS classes(c) GROUP BY 1
),
steps AS (SELECT p, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM judged GROUP BY 1),
walked AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS seen FROM steps)""",
            """SELECT round((SELECT count(*) FILTER (label = pred) / count(*) FROM judged), 9) AS accuracy,
                 round((SELECT sum(truth * f1) / sum(truth) FROM per_class), 9) AS f1,
                 round((SELECT sum(neg * (seen - pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) FROM walked), 9) AS auc""",
        ),
        "model_metrics_exact": _with(
            PROCESSED
            + """,
judged AS (
  SELECT CAST(is_domestic_incident AS INTEGER) AS label, (CAST("ID" AS BIGINT) * 7919 % 65521) / 65521.0::DOUBLE AS p
  FROM processed
),
steps AS (SELECT p, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM judged
          WHERE label IS NOT NULL GROUP BY 1),
walked AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS seen FROM steps)""",
            """SELECT (SELECT count(DISTINCT p) FROM judged) AS scores,
                 round((SELECT sum(neg * (seen - pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)) FROM walked), 9) AS auc""",
        ),
        "top3_candidates": _with(
            PROCESSED
            + f""",
weights AS (
  SELECT "ID", unnest(range(5)) AS i, ((CAST("ID" AS BIGINT) + 3) * (unnest(range(5)) + 2) % 17) / 16.0::DOUBLE AS p
  FROM processed
),
placed AS (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY p DESC, i) AS place FROM weights)""",
            f"""SELECT "ID",
                  max(list_extract([{_list(CRIME_CLASSES)}], i + 1) || ':' || printf('%.3f', p)) FILTER (place = 1) AS first,
                  max(list_extract([{_list(CRIME_CLASSES)}], i + 1) || ':' || printf('%.3f', p)) FILTER (place = 2) AS second,
                  max(list_extract([{_list(CRIME_CLASSES)}], i + 1) || ':' || printf('%.3f', p)) FILTER (place = 3) AS third
                FROM placed GROUP BY 1""",
        ),
        "latest_runs": _with(
            RUNS,
            """SELECT task_type, created_at, created_at_ts, n AS training_records, accuracy, f1, auc FROM runs
               WHERE task_type = 'domestic_incident_prediction' ORDER BY created_at DESC LIMIT 20""",
        ),
        "metric_comparison": _with(
            RUNS + """,
newest AS (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY created_at DESC) AS rn FROM runs)""",
            """SELECT task_type, unnest(['accuracy', 'f1', 'auc']) AS metric, unnest([accuracy, f1, auc]) AS score
               FROM newest WHERE rn = 1""",
        ),
        "run_feature_topk": _with(
            RUNS + """,
newest AS (SELECT day, n FROM runs WHERE task_type = 'domestic_incident_prediction' ORDER BY created_at DESC LIMIT 1)""",
            """SELECT 'hour_' || hour(ts) AS feature, count(*) / any_value(n) AS importance
               FROM events JOIN newest ON CAST(ts AS DATE) = day GROUP BY 1
               ORDER BY importance DESC, feature LIMIT 15""",
        ),
    }
