"""Golden values of the scalar functions."""

from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from beatline.functions import casts, offences, sampling, times


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = rows.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in found]


def check(spark, function, expected, kind="string"):
    assert dict(zip(expected, apply(spark, function, list(expected), kind))) == expected


def test_safe_int_on_known_texts(spark):
    check(
        spark,
        casts.safe_int,
        {
            "12": 12, "12.0": 12, "12.7": 12, "-12.7": -12, "012": 12, "+3": 3, " 7 ": 7, "5.": 5, ".5": 0, "-3": -3,
            "": None, "1e3": None, "abc": None, "1.2.3": None, "99999999999": None, "99999999999.0": None, None: None,
        },
    )


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("0123456789.+-e ", max_size=8), min_size=20, max_size=60))
def test_safe_int_is_the_lenient_cast(spark, texts):
    # blanks between sign, digits and dot are the one place where the two may differ
    texts = [t for t in texts if " " not in t.strip()]
    ours = apply(spark, casts.safe_int, texts)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        lenient = apply(spark, lambda c: c.cast("int"), texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert dict(zip(texts, ours)) == dict(zip(texts, lenient))


def test_safe_double(spark):
    check(
        spark,
        casts.safe_double,
        {"41.5": 41.5, " -87.6 ": -87.6, "1e3": 1000.0, "": None, " ": None, "x": None, None: None},
    )


def test_text_flag(spark):
    check(
        spark,
        casts.text_flag,
        {"true": True, "TRUE": True, "False": False, "t": None, "1": None, " true": None, "maybe": None, None: None},
    )


def test_incident_time(spark):
    check(
        spark,
        times.incident_time,
        {
            "01/31/2024 12:05:09 AM": datetime(2024, 1, 31, 0, 5, 9),
            "01/31/2024 12:05:09 PM": datetime(2024, 1, 31, 12, 5, 9),
            "2024-02-29T23:59:59.250": datetime(2024, 2, 29, 23, 59, 59, 250000),
            "2024-02-29T23:59:59": datetime(2024, 2, 29, 23, 59, 59),
            "2024-02-29T23:59:59Z": None,
            "2024-02-29 23:59:59": None,
            "02/30/2024 01:00:00 AM": None,
            "13:00": None,
            "n/a": None,
            "": None,
            None: None,
        },
    )


def test_incident_time_is_the_first_format_that_fits(spark):
    formats = [times.CSV_FORMAT, times.ISO_MILLIS_FORMAT, times.ISO_FORMAT]
    texts = [
        "01/31/2024 12:05:09 AM", "2024-01-31T12:05:09.1", "2024-01-31T12:05:09.123", "2024-01-31T12:05:09",
        "1/31/2024 1:05:09 AM", "2024/01/31T12:05:09", "01/31/2024 13:05:09 PM", "01/31/2024T12:05:09", "./", "T",
    ]
    every = lambda c: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])
    assert apply(spark, times.incident_time, texts) == apply(spark, every, texts)


def test_csv_time_knows_one_layout(spark):
    check(spark, times.csv_time, {"01/31/2024 01:05:09 PM": datetime(2024, 1, 31, 13, 5, 9), "2024-01-31T13:05:09": None})


def test_change_time_like_the_strptime_formats(spark):
    formats = [
        "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M:%S.%f",
        "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S",
    ]

    def first_fit(text):
        for layout in formats:
            try:
                return datetime.strptime(text.strip(), layout)
            except ValueError:
                continue
        return None

    texts = [
        "01/02/2024 03:04:05 PM", "1/2/2024 3:4:5 pm", "01/02/2024 15:04:05", "01/02/2024 15:04:05 PM",
        "2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05.1", "2024-01-02T03:04:05.12", "2024-01-02T03:04:05.1234",
        "2024-01-02T03:04:05.12345", "2024-01-02T03:04:05.000", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05",
        "2024-01-02 03:04:05", "  2024-01-02 03:04:05\t", "2024-13-02T03:04:05", "2024-01-02", "soon", "",
        "2024-1-02T03:04:05.1234", "2024-01-02t03:04:05z", "2024-02-30T00:00:00.000",
    ]
    assert dict(zip(texts, apply(spark, times.change_time, texts))) == {t: first_fit(t) for t in texts}


@pytest.mark.parametrize(
    "hour, part, night, wide",
    [
        (3, "NIGHT", True, True), (4, "NIGHT", False, True), (5, "MORNING", False, True), (6, "MORNING", False, False),
        (11, "MORNING", False, False), (12, "AFTERNOON", False, False), (16, "AFTERNOON", False, False),
        (17, "EVENING", False, False), (21, "EVENING", False, False), (22, "NIGHT", True, True), (0, "NIGHT", True, True),
    ],
)
def test_hour_edges(spark, hour, part, night, wide):
    row = spark.range(1).select(
        times.day_part(F.lit(hour)), times.in_night(F.lit(hour)), times.in_night(F.lit(hour), 22, 6)
    ).first()
    assert tuple(row) == (part, night, wide)


def test_seasons_and_day_names(spark):
    names = apply(spark, times.season, list(range(1, 13)), "int")
    assert names == ["WINTER"] * 2 + ["SPRING"] * 3 + ["SUMMER"] * 3 + ["FALL"] * 3 + ["WINTER"]
    assert apply(spark, times.day_name, [1, 2, 7, None], "int") == ["Sun", "Mon", "Sat", None]


def test_place_categories(spark):
    check(
        spark,
        offences.place_category,
        {
            "STREET": "Public Outdoor", "RESIDENCE": "Residential", "APARTMENT": "Residential",
            "SIDEWALK": "Public Outdoor", "PARKING LOT/GARAGE(NON.RESID.)": "Residential",
            "SMALL RETAIL STORE": "Commercial", "RESTAURANT": "Food & Entertainment",
            "SCHOOL, PUBLIC, BUILDING": "Institutional", "CTA TRAIN": "Transportation",
            "BARBERSHOP": "Food & Entertainment", "WAREHOUSE": "Residential", "JUNK YARD": "Residential",
            "COMMERCIAL / BUSINESS OFFICE": "Transportation", "FACTORY/MANUFACTURING BUILDING": "Industrial",
            "DRIVEWAY - RESIDENTIAL": "Other", "PARK PROPERTY": "Public Outdoor",
            "BOWLING ALLEY": "Food & Entertainment", "GAS STATION": "Other", "alley": "Public Outdoor",
            "BANK": "Commercial", "POLICE FACILITY/VEH PARKING LOT": "Transportation",
            "TRUCKING TERMINAL": "Transportation", "CONSTRUCTION SITE": "Industrial", "": "Other", None: "Other",
        },
    )


def test_every_place_word_finds_its_first_category(spark):
    words = [word for group in offences.PLACE_WORDS.values() for word in group]

    def first_category(text):
        return next(c for c, group in offences.PLACE_WORDS.items() if any(w in text for w in group))

    texts = words + [f"AT {w.lower()} 5" for w in words]
    expected = {t: first_category(t.upper()) for t in texts}
    assert dict(zip(texts, apply(spark, offences.place_category, texts))) == expected


@pytest.mark.parametrize(
    "offence, category, level, weight",
    [
        ("THEFT", "Property Crime", "Level 1", 1.0), ("BATTERY", "Violent Crime", "Level 2", 3.0),
        ("HOMICIDE", "Violent Crime", "Level 3", 10.0), ("NARCOTICS", "Drug/Weapon Crime", "Level 2", 3.0),
        ("GAMBLING", "Public Order Crime", "Level 1", 1.0), ("ARSON", "Property Crime", "Level 3", 10.0),
        ("PROSTITUTION", "Other Crime", "Level 2", 3.0), ("BURGLARY", "Property Crime", "Level 2", 3.0),
        ("OTHER OFFENSE", "Property Crime", "Level 1", 1.0), ("ROBBERY", "Violent Crime", "Level 2", 3.0),
        ("crim sexual assault", "Violent Crime", "Level 3", 10.0), ("", "Other Crime", "Level 1", 1.0),
        (None, "Other Crime", "Level 1", 1.0),
    ],
)
def test_offences(spark, offence, category, level, weight):
    column = F.lit(offence).cast("string")
    row = spark.range(1).select(
        offences.crime_category(column), offences.severity_level(column), offences.severity_weight(column)
    ).first()
    assert tuple(row) == (category, level, weight)


@pytest.mark.parametrize(
    "severity, place, night, domestic, public, raw, score",
    [
        (1.0, 1.0, False, False, False, 2.0, 1.0),
        (3.0, 2.0, True, True, False, 8.5, 4.774193548387097),
        (10.0, 3.0, True, False, True, 16.0, 9.129032258064516),
        (10.0, 3.0, True, True, True, 17.5, 10.0),
        (3.0, 3.0, True, None, True, 9.0, 5.064516129032258),
    ],
)
def test_risk(spark, severity, place, night, domestic, public, raw, score):
    flags = [F.lit(flag).cast("boolean") for flag in (night, domestic, public)]
    total = offences.raw_risk(F.lit(severity), F.lit(place), *flags)
    assert tuple(spark.range(1).select(total, offences.risk_score(total)).first()) == (raw, score)


def test_key_fraction_is_even_and_independent_of_layout(spark):
    keys = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    drawn = lambda df: df.select(
        "k", sampling.key_fraction(F.col("k"), 42).alias("a"), sampling.key_fraction(F.col("k"), 42, 1).alias("b")
    )
    rows = drawn(keys).collect()
    assert sorted(rows) == sorted(drawn(keys.repartition(13)).collect())
    share = lambda test: sum(map(test, rows)) / len(rows)
    assert abs(share(lambda r: r["a"] < 0.7) - 0.7) < 0.02
    assert abs(share(lambda r: r["a"] < 0.5 and r["b"] < 0.5) - 0.25) < 0.02
    assert all(0 <= r["a"] < 1 and 0 <= r["b"] < 1 for r in rows)
