"""Time-of-day segments and daily temperature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterweave import schema
from meterweave.functions import clock
from meterweave.operators.calendar import is_weekday
from meterweave.plans.days import with_date


def hour_of(minute: str = "minute_of_day") -> Column:
    return F.floor(F.col(minute) / 60)


def segment_aggregates() -> list[Column]:
    """Peaks of the named segments, means of night and day; night is outside the daytime hours."""
    kw, hour = F.col("demand_kw"), hour_of()
    by_day = clock.in_hours(hour, schema.DAYTIME)
    peaks = [
        F.max(F.when(clock.in_hours(hour, bounds), kw)).alias(f"{name}_peak_kw")
        for name, bounds in schema.SEGMENTS.items()
    ]
    night = F.avg(F.when(~by_day, kw))
    return [
        *peaks,
        night.alias("overnight_mean_kw"),
        night.alias("nighttime_mean_kw"),
        F.avg(F.when(by_day, kw)).alias("daytime_mean_kw"),
    ]


def segment_features(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("entity_id", "date").agg(*segment_aggregates())


def daily_temperature(observations: DataFrame, key: str = "meter_id") -> DataFrame:
    """Mean, extremes and range of temperature per day; no rows for a series without temperature."""
    days = with_date(observations).groupBy(key, "date").agg(
        F.avg("temperature_f").alias("mean_temperature_f"),
        F.max("temperature_f").alias("maximum_temperature_f"),
        F.min("temperature_f").alias("minimum_temperature_f"),
        (F.max("temperature_f") - F.min("temperature_f")).alias("temperature_range_f"),
    )
    measured = days.where("mean_temperature_f is not null").select(key).distinct()
    return days.join(measured, key, "left_semi").withColumnRenamed(key, "entity_id")


def representative_meters(observations: DataFrame, members: DataFrame) -> DataFrame:
    """(entity_id, meter_id): the member with the most temperatures, the first by id of several.

    Temperature belongs to the site and is not summed, so an entity takes it from
    one member. An entity whose members have none is left out. Counts are formed
    per meter first; only they meet the members.
    """
    covered = observations.groupBy("meter_id").agg(F.count("temperature_f").alias("known")).where("known > 0")
    pairs = members.select("entity_id", "meter_id").distinct()
    best = F.struct(-F.col("known"), "meter_id")
    return pairs.join(covered, "meter_id").groupBy("entity_id").agg(F.min_by("meter_id", best).alias("meter_id"))


def entity_temperature(observations: DataFrame, members: DataFrame) -> DataFrame:
    """As daily_temperature, for every entity: meters, groups and the portfolio, each by its representative meter."""
    days = daily_temperature(observations).withColumnRenamed("entity_id", "meter_id")
    return representative_meters(observations, members).join(days, "meter_id").drop("meter_id")


def temperature_band(temperature: Column, bands: Sequence[float]) -> Column:
    """Label of the right-closed band; NULL stays NULL."""
    edges = sorted(bands)
    names = [str(int(e)) for e in edges]
    labels = [f"{a}-{b}" for a, b in zip(["below", *names], [*names, "above"])]
    if len(set(labels)) < len(labels):
        raise ValueError(f"band labels collide: {labels}")
    band = F.when(temperature.isNotNull() & F.lit(not edges), labels[0])
    for edge, label in zip(edges, labels):
        band = band.when(temperature <= edge, label)
    return band.when(temperature.isNotNull(), labels[-1])


def temperature_bands(rows: DataFrame, bands: Sequence[float], temperature: str = "temperature_f") -> DataFrame:
    return rows.withColumn("temperature_band", temperature_band(F.col(temperature), bands))


def weekday_daily_means(observations: DataFrame) -> DataFrame:
    """Mean temperature and demand per meter and weekday; holidays count as weekdays."""
    rows = with_date(observations)
    return (
        rows.where(is_weekday(F.col("date")))
        .groupBy("meter_id", "date")
        .agg(F.avg("temperature_f").alias("temperature_f"), F.avg("analysis_demand_kw").alias("demand_kw"))
    )
