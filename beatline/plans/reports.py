"""Compute the result collections from the processed table."""

from pyspark.sql import DataFrame

from beatline.operators import areas, trends
from beatline.session import staged
from beatline.sinks.tables import replace_result


def result_collections(processed: DataFrame) -> dict[str, DataFrame]:
    return {
        "crime_by_year": trends.yearly_counts(processed),
        "hourly_patterns": trends.hourly_by_day_type(processed),
        "arrest_rates": trends.arrest_rate_by_type(processed),
        "district_analysis": trends.district_stats(processed),
    }


def publish_results(processed: DataFrame, folder: str, sink_format: str = "parquet", **options: str) -> None:
    """Replace the four collections, each under its name in the folder."""
    for name, result in result_collections(processed).items():
        replace_result(result, f"{folder}/{name}", sink_format, **options)


def night_risk(processed: DataFrame) -> DataFrame:
    """Districts with their quadrant.  The district rows are written once and read for rows and averages."""
    return trends.night_risk_quadrants(staged(trends.night_risk_by_district(processed), "districts"))


def choropleth(processed: DataFrame, boundaries: DataFrame, area_key: str) -> dict[str, DataFrame]:
    """The tables behind an area map: counts with classes, class edges, and boundaries with counts.

    The incidents are read once; the rest works on the area counts.
    """
    counts = staged(areas.area_counts(processed), "area-counts")
    edges = areas.class_edges(counts)
    return {
        "areas": areas.assign_classes(counts, edges),
        "edges": edges,
        "boundaries": areas.counts_on_boundaries(boundaries, counts, area_key),
    }
