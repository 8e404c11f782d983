"""Incident counts and rates by time, type and district, on the processed table."""

from pyspark.sql import Column, DataFrame, functions as F

from beatline.functions import times

HOURS = list(range(24))


def yearly_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("Year").agg(F.count("*").alias("crime_count")).orderBy("Year")


def type_counts(df: DataFrame, top: int | None = None) -> DataFrame:
    """Incidents by type, most frequent first; ``top`` keeps the first types only."""
    counts = (
        df.groupBy("Primary Type")
        .agg(F.count("*").alias("crime_count"))
        .orderBy(F.desc("crime_count"), "Primary Type")
    )
    return counts if top is None else counts.limit(top)


def hourly_by_day_type(df: DataFrame) -> DataFrame:
    """Incidents by hour, weekend and weekday apart; the label is put on the groups, not on every row."""
    weekend = F.coalesce(times.is_weekend(F.col("crime_day_of_week")), F.lit(False))
    return (
        df.groupBy("crime_hour", weekend.alias("weekend"))
        .agg(F.count("*").alias("crime_count"))
        .select("crime_hour", F.when(F.col("weekend"), "Weekend").otherwise("Weekday").alias("day_type"), "crime_count")
        .orderBy("crime_hour", "day_type")
    )


def arrest_rate_by_type(df: DataFrame, top: int = 20) -> DataFrame:
    """Share of incidents with an arrest, in percent; an unknown arrest counts as none."""
    return (
        df.groupBy("Primary Type")
        .agg(F.count("*").alias("total_crimes"), F.count_if("was_arrest_made").alias("arrests"))
        .withColumn("arrest_rate", F.try_divide("arrests", "total_crimes") * 100)
        .orderBy(F.desc("arrest_rate"), "Primary Type")
        .limit(top)
    )


def district_stats(df: DataFrame) -> DataFrame:
    """Incidents and arrest share per district, unknown district included; unknown arrest counts as none."""
    return (
        df.groupBy("District")
        .agg(
            F.count("*").alias("crime_count"),
            F.avg(F.when(F.col("was_arrest_made"), 1).otherwise(0)).alias("arrest_rate"),
        )
        .orderBy(F.desc("crime_count"), "District")
    )


def night_risk_by_district(df: DataFrame, night: Column | None = None) -> DataFrame:
    """Night share and arrest share per known district; here an unknown arrest is left out.

    ``night`` replaces the stored flag, for instance ``in_night(col("crime_hour"), 22, 6)``.
    """
    at_night = F.col("is_night") if night is None else night
    return (
        df.filter(F.col("District").isNotNull())
        .groupBy("District")
        .agg(
            F.count("*").alias("total_crimes"),
            F.sum(at_night.cast("int")).alias("night_crimes"),
            F.avg(F.col("Arrest").cast("int")).alias("arrest_rate"),
        )
        .withColumn("night_crime_ratio", F.try_divide("night_crimes", "total_crimes"))
    )


def night_risk_averages(districts: DataFrame) -> DataFrame:
    """The plain mean over districts, not weighted by incidents: one row."""
    return districts.agg(
        F.avg("night_crime_ratio").alias("avg_night"), F.avg("arrest_rate").alias("avg_arrest")
    )


def night_risk_quadrants(districts: DataFrame) -> DataFrame:
    """Each district's place against the two averages."""
    averages = night_risk_averages(districts).select(F.struct("avg_night", "avg_arrest")).scalar()
    both = {name: averages.getField(name) for name in ("avg_night", "avg_arrest")}
    return districts.withColumns(both).withColumn(
        "quadrant",
        F.concat(
            F.when(F.col("night_crime_ratio") >= F.col("avg_night"), "high night").otherwise("low night"),
            F.lit(", "),
            F.when(F.col("arrest_rate") >= F.col("avg_arrest"), "high arrest").otherwise("low arrest"),
        ),
    )


def weekday_hour_counts(df: DataFrame, csv_dates_only: bool = False) -> DataFrame:
    """Incidents by weekday name and hour.

    ``csv_dates_only`` reads the date text again in the CSV layout alone; rows in another layout then
    fall into the group where weekday and hour are NULL.
    """
    if csv_dates_only:
        moment = times.csv_time(F.col("Date"))
        day, hour = F.dayofweek(moment), F.hour(moment)
    else:
        day, hour = F.col("crime_day_of_week"), F.col("crime_hour")
    counts = df.groupBy(day.alias("day"), hour.alias("hour")).agg(F.count("*").alias("crime_count"))
    return counts.select(times.day_name(F.col("day")).alias("weekday"), "hour", "crime_count")


def weekday_hour_matrix(counts: DataFrame) -> DataFrame:
    """Weekdays Monday to Sunday by hours 0-23; a cell without incidents is NULL."""
    order = F.array_position(F.array(*[F.lit(d) for d in times.WEEK_ORDER]), F.col("weekday"))
    cells = [F.sum(F.when(F.col("hour") == h, F.col("crime_count"))).alias(f"h{h:02d}") for h in HOURS]
    return counts.filter(F.col("weekday").isNotNull()).groupBy("weekday").agg(*cells).coalesce(1).sortWithinPartitions(order)


def row_counts(raw: DataFrame, processed: DataFrame) -> DataFrame:
    total = F.count("*").alias("n")
    return processed.agg(F.count("*").alias("processed_rows")).withColumn("raw_rows", raw.agg(total).scalar())
