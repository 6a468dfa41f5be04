"""Daily profiles and daily features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterweave.functions import clock
from meterweave.plans.days import in_day, whole_day, with_date

ENTITY = ["entity_id"]


def daily_profiles(load: DataFrame, interval_minutes: int) -> DataFrame:
    """Add interval_index, minute_of_day, time_of_day and is_complete_day.

    A day is the calendar date of the interval-ending stamp. It is complete if
    it has the expected number of rows and none is missing; others are kept.
    """
    expected = clock.intervals_per_day(interval_minutes)
    rows = with_date(load)
    day = whole_day(ENTITY)
    ranked = F.row_number().over(in_day(ENTITY)) - 1
    full = (F.count(F.lit(1)).over(day) == expected) & (F.count("demand_kw").over(day) == expected)
    return rows.select(
        "entity_id", "date", "timestamp",
        ranked.alias("interval_index"),
        clock.minute_of_day(F.col("timestamp")).alias("minute_of_day"),
        F.date_format("timestamp", "HH:mm:ss").alias("time_of_day"),
        "demand_kw",
        full.alias("is_complete_day"),
    )


def normalized_profiles(profiles: DataFrame) -> DataFrame:
    """Add normalized_demand = demand / peak of the day; NULL if the peak is not positive."""
    peak = F.max("demand_kw").over(whole_day(ENTITY))
    return profiles.withColumn("_peak", peak).withColumn(
        "normalized_demand", F.when(F.col("_peak") > 0, F.col("demand_kw") / F.col("_peak"))
    ).drop("_peak")


def ratio(numerator: str, denominator: str) -> Column:
    return F.when(F.col(denominator) > 0, F.col(numerator) / F.col(denominator))


def daily_features(profiles: DataFrame, interval_minutes: int) -> DataFrame:
    """One row per (entity, date). A day without any value has energy 0 and NULL elsewhere."""
    kw = F.col("demand_kw")
    first_peak = F.min_by("minute_of_day", F.when(kw.isNotNull(), F.struct(-kw, "minute_of_day")))
    days = profiles.groupBy("entity_id", "date").agg(
        F.avg(kw).alias("mean_demand_kw"),
        F.max(kw).alias("maximum_demand_kw"),
        F.min(kw).alias("minimum_demand_kw"),
        (F.coalesce(F.sum(kw), F.lit(0.0)) * interval_minutes / 60).alias("daily_energy_kwh"),
        first_peak.alias("peak_minute"),
        F.stddev_samp(kw).alias("standard_deviation_kw"),
        F.max("is_complete_day").alias("is_complete_day"),
    )
    return days.select(
        "entity_id", "date", "mean_demand_kw", "maximum_demand_kw", "minimum_demand_kw", "daily_energy_kwh",
        "peak_minute",
        F.when(
            F.col("peak_minute").isNotNull(), F.concat(clock.hhmm(F.col("peak_minute")), F.lit(":00"))
        ).alias("peak_time"),
        ratio("mean_demand_kw", "maximum_demand_kw").alias("load_factor"),
        ratio("maximum_demand_kw", "mean_demand_kw").alias("peak_to_average_ratio"),
        "standard_deviation_kw",
        ratio("standard_deviation_kw", "mean_demand_kw").alias("coefficient_of_variation"),
        "is_complete_day",
    )


def day_coverage(load: DataFrame, members: DataFrame, interval_minutes: int) -> DataFrame:
    """Per (entity, date): whether every member reported at every interval.

    A group's day is complete when any member reports, so this is stated apart.
    """
    expected = clock.intervals_per_day(interval_minutes)
    sizes = members.groupBy("entity_id").agg(F.countDistinct("meter_id").alias("n_meters"))
    days = with_date(load).groupBy("entity_id", "date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("n_meters_reporting").alias("fewest_reporting")
    )
    return days.join(sizes, "entity_id").select(
        "entity_id", "date", "fewest_reporting",
        ((F.col("n_rows") == expected) & (F.col("fewest_reporting") == F.col("n_meters"))).alias("is_fully_covered"),
    )
