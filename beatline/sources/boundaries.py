"""Area boundaries from a GeoJSON feature collection."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _text(value: Column) -> Column:
    """Text of a property; a JSON number that is whole is written as one, whether it has a fraction of 0 or not."""
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    whole = ~kind.isin("STRING", "BOOLEAN") & (number == F.floor(number))
    return F.when(whole, number.cast("bigint").cast("string")).otherwise(F.try_variant_get(value, "$", "string"))


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature with its ``properties`` as a map of texts; the geometry is not read.

    A key that the file gives as the number ``35.0`` is ``35``, as the text ``"35.0"`` it stays that.  A feature collection is one
    JSON value, so one task reads each file.
    """
    schema = "features array<struct<properties: map<string, variant>>>"
    collection = spark.read.schema(schema).option("multiLine", True).json(path)
    features = collection.select(F.explode("features").alias("feature"))
    return features.select(F.transform_values("feature.properties", lambda _, value: _text(value)).alias("properties"))
