"""Area counts, class edges and map cells against plain Python."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from beatline.operators import areas
from beatline.plans import reports
from beatline.sources.boundaries import read_boundaries


def counts(spark, values):
    return spark.createDataFrame(list(enumerate(values, 1)), "community_area int, crime_count bigint")


def expected_edges(values):
    quantiles = pd.Series(values, dtype=float).quantile([0.0, 0.2, 0.4, 0.6, 0.8, 1.0])
    edges = sorted({int(round(q)) for q in quantiles})
    if len(edges) < 3:
        low, high = min(values), max(values)
        step = max(1, int((high - low) / 5.0))
        edges = [low + k * step for k in range(5)] + [high]
    return edges


@pytest.mark.parametrize(
    "values",
    [[1, 2, 3, 4, 5, 6, 7], [5, 5, 5], [9], [1, 1, 1, 1, 100], [1, 2], [2, 3, 4, 5], [random.Random(1).randint(1, 9999) for _ in range(77)]],
)
def test_class_edges(spark, values):
    found = areas.class_edges(counts(spark, values)).first()["edges"]
    assert found == expected_edges(values)


def test_classes_hold_their_lower_edge(spark):
    table = counts(spark, [1, 2, 3, 4, 5, 6, 7])
    classes = areas.assign_classes(table, areas.class_edges(table)).orderBy("crime_count").collect()
    assert [r["class_no"] for r in classes] == [1, 2, 3, 3, 4, 5, 5]
    same = counts(spark, [5, 5])
    assert {r["class_no"] for r in areas.assign_classes(same, areas.class_edges(same)).collect()} == {1}


def test_counts_on_boundaries(spark, tmp_path):
    keys = ["1", "2", "3", "abc", None]
    features = [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"area_numbe": k, "community": "X"}}
        for k in keys
    ] + [{"type": "Feature", "properties": {}}]
    (tmp_path / "areas.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    shapes = read_boundaries(spark, str(tmp_path / "areas.geojson"))
    joined = areas.counts_on_boundaries(shapes, counts(spark, [10, 20]), "area_numbe").collect()
    found = sorted((r["properties"].get("area_numbe") or "", r["crime_count"]) for r in joined)
    assert found == [("", 0), ("", 0), ("1", 10), ("2", 20), ("3", 0), ("abc", 0)]


def test_map_tables_agree(spark):
    incidents = spark.createDataFrame([(1,), (1,), (2,), (None,)], "`Community Area` int")
    shapes = spark.createDataFrame([({"no": "1"},), ({"no": "7"},)], "properties map<string,string>")
    tables = reports.choropleth(incidents, shapes, "no")
    assert sorted((r["community_area"], r["crime_count"]) for r in tables["areas"].collect()) == [(1, 2), (2, 1)]
    assert sorted(r["crime_count"] for r in tables["boundaries"].collect()) == [0, 2]


def test_grid_and_sample(spark):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("ID"),
        F.when(F.col("id") % 10 > 0, 41.6 + F.col("id") / 10000).alias("Latitude"),
        F.lit(-87.505).alias("Longitude"),
    )
    grid = areas.heat_grid(rows, cell=0.1).collect()
    assert sum(r["crime_count"] for r in grid) == 4500
    assert {r["lon_cell"] for r in grid} == {-876}
    assert {r["lat_cell"] for r in grid} <= set(range(415, 422))
    sampled = areas.sample_coordinates(rows, fraction=0.1)
    assert sampled.columns == ["Latitude", "Longitude"]
    assert 350 < sampled.count() < 550
    assert sorted(sampled.collect()) == sorted(areas.sample_coordinates(rows.repartition(7), fraction=0.1).collect())
