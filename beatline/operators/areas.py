"""Counts on community areas and map cells, and the classes of a choropleth."""

import math

from pyspark.sql import DataFrame, functions as F

from beatline.functions.sampling import key_fraction
from beatline.operators.clean import require_columns

# The quantiles whose values bound the five classes.
CLASS_QUANTILES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
CLASS_COUNT = 5

# How far an incident spreads on the heat map, and over what part of that its weight falls to nothing.
HEAT_RADIUS, HEAT_BLUR = 7, 4


def area_counts(df: DataFrame) -> DataFrame:
    return (
        df.select(F.col("Community Area").cast("int").alias("community_area"))
        .filter(F.col("community_area").isNotNull())
        .groupBy("community_area")
        .agg(F.count("*").alias("crime_count"))
        .orderBy(F.desc("crime_count"), "community_area")
    )


def counts_on_boundaries(boundaries: DataFrame, counts: DataFrame, area_key: str) -> DataFrame:
    """Every boundary with its incident count; an unknown or unreadable area has 0.

    The join has no hint: both sides are small in practice, and Spark broadcasts one once it has seen
    its size.
    """
    area = F.col("properties").getItem(area_key).try_cast("int")
    keyed = boundaries.withColumn("community_area", area)
    return keyed.join(counts, "community_area", "left").withColumn(
        "crime_count", F.coalesce("crime_count", F.lit(0).cast("bigint"))
    )


def class_edges(counts: DataFrame) -> DataFrame:
    """One row with the ascending class edges in ``edges``.

    Quantiles of the counts, rounded half to even, without repeats.  With fewer than three left, five even
    steps from the least count and then the greatest, which need not ascend.
    """
    count = F.col("crime_count")
    quantiles = F.percentile(count, F.array(*[F.lit(q) for q in CLASS_QUANTILES]))
    found = counts.agg(
        quantiles.alias("quantiles"),
        F.min(count).cast("bigint").alias("least"),
        F.max(count).cast("bigint").alias("most"),
    )
    least, most = F.col("least"), F.col("most")
    step = F.greatest(F.lit(1), ((most - least) / CLASS_COUNT).cast("bigint"))
    steps = F.transform(F.sequence(F.lit(0), F.lit(CLASS_COUNT - 1)), lambda k: least + k * step)
    rounded = F.transform("quantiles", lambda q: F.bround(q, 0).cast("bigint"))
    edges = F.array_sort(F.array_distinct(rounded))
    return found.select(F.when(F.size(edges) < 3, F.array_append(steps, most)).otherwise(edges).alias("edges"))


def assign_classes(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """Class number of each count, from 1; classes hold their lower edge, the last also its upper."""
    ascending = edges.select(F.array_sort(F.array_distinct("edges")).alias("edges"))
    with_edges = counts.withColumn("_edges", ascending.scalar())
    reached = F.size(F.filter("_edges", lambda edge: edge <= F.col("crime_count")))
    return with_edges.withColumn(
        "class_no", F.greatest(F.lit(1), F.least(reached, F.size("_edges") - 1))
    ).drop("_edges")


def heat_grid(df: DataFrame, cell: float = 0.01) -> DataFrame:
    """Incidents per map cell of ``cell`` degrees, over every row that has a position."""
    size = F.lit(cell)
    return (
        df.transform(require_columns, ["Latitude", "Longitude"])
        .groupBy(
            F.floor(F.col("Latitude") / size).alias("lat_cell"),
            F.floor(F.col("Longitude") / size).alias("lon_cell"),
        )
        .agg(F.count("*").alias("crime_count"))
    )


def _kernel(radius: int, blur: int) -> list[tuple[int, int, int]]:
    """(rows up, columns right, weight in thousandths) of the cells within the radius."""
    reach = range(-radius, radius + 1)
    away = {(y, x): math.hypot(y, x) for y in reach for x in reach}
    weights = {place: math.floor(1000 * min(1.0, (radius - d) / blur)) for place, d in away.items() if d < radius}
    return [(y, x, w) for (y, x), w in weights.items() if w > 0]


def heat_density(
    df: DataFrame, cell: float = 0.001, zooms: int = 3, radius: int = HEAT_RADIUS, blur: int = HEAT_BLUR
) -> DataFrame:
    """``density`` of the heat map per zoom level and cell: the incidents around, those near by in full.

    At zoom 0 cells have ``cell`` degrees, at each further one twice as many.  An incident counts in full up to ``radius - blur`` cells
    away and less and less up to ``radius``.  Incidents are counted per cell of the finest level, in one pass that shuffles counts
    only, then per coarser cell, and each cell's count spreads to the cells around it before they are summed: rows grow
    with the cells that hold incidents, not with incidents.  Weights are whole thousandths, so sums do not depend on their order.
    """
    if radius <= 0 or not 0 < blur <= radius or zooms < 1:
        raise ValueError("radius and blur must be above 0, blur not above radius, and there must be a zoom level")
    counts = heat_grid(df, cell)
    levels = F.array(
        *(
            F.struct(
                F.lit(zoom).alias("zoom"),
                F.floor(F.col("lat_cell") / (1 << zoom)).alias("lat_cell"),
                F.floor(F.col("lon_cell") / (1 << zoom)).alias("lon_cell"),
            )
            for zoom in range(zooms)
        )
    )
    cells = counts.select(F.explode(levels).alias("at"), "crime_count")
    cells = cells.groupBy("at.zoom", "at.lat_cell", "at.lon_cell").agg(F.sum("crime_count").alias("crime_count"))
    kernel = F.array(
        *(F.struct(F.lit(y).alias("y"), F.lit(x).alias("x"), F.lit(w).alias("w")) for y, x, w in _kernel(radius, blur))
    )
    spread = cells.select("zoom", "lat_cell", "lon_cell", "crime_count", F.explode(kernel).alias("k"))
    weight = F.sum(F.col("crime_count") * F.col("k.w"))
    summed = spread.groupBy(
        "zoom", (F.col("lat_cell") + F.col("k.y")).alias("lat_cell"), (F.col("lon_cell") + F.col("k.x")).alias("lon_cell")
    ).agg((weight / 1000).alias("density"))
    return summed


def sample_coordinates(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """Positions of a fixed share of the incidents, for a point map."""
    return (
        df.transform(require_columns, ["Latitude", "Longitude"])
        .filter(key_fraction(F.col("ID"), seed) < fraction)
        .select("Latitude", "Longitude")
    )
