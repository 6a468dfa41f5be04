"""Nearest-stamp join of site temperature."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterweave.functions import clock
from meterweave.plans.days import with_date, with_neighbours


def one_per_stamp(weather: DataFrame) -> DataFrame:
    """Weather with unique stamps: of equal stamps the lowest known temperature."""
    return weather.groupBy("timestamp").agg(F.min("temperature_f").alias("temperature_f"))


def nearest_weather(stamps: DataFrame, weather: DataFrame, tolerance_minutes: float | None = None) -> DataFrame:
    """(timestamp, external_temperature_f) for each stamp that has a weather row within reach.

    Each weather row serves the stamps between the midpoints to its neighbours; a
    stamp on a midpoint takes the earlier row, the tolerance is inclusive. The
    range test is an equi-join on the hours a serving interval touches.
    """
    bucket = 60 * clock.MINUTE
    stamps = stamps.select("timestamp").where("timestamp is not null").distinct().withColumn("at", clock.micros(F.col("timestamp")))
    rows = with_date(one_per_stamp(weather)).withColumn("at", clock.micros(F.col("timestamp")))
    rows = with_neighbours(rows, [], "at", ("before", "after"))
    # Twice the time keeps midpoints whole: lo < 2 * stamp <= hi.
    lo, hi = F.col("before") + F.col("at"), F.col("after") + F.col("at")
    if tolerance_minutes:
        reach = int(tolerance_minutes * clock.MINUTE)
        lo = F.greatest(lo, 2 * (F.col("at") - reach) - 1)
        hi = F.least(hi, 2 * (F.col("at") + reach))
    # The open ends reach as far as the stamps do; greatest and least skip NULL.
    first = stamps.agg(2 * F.min("at") - 1).scalar()
    last = stamps.agg(2 * F.max("at")).scalar()
    served = (
        rows.withColumn("lo", F.greatest(lo, first))
        .withColumn("hi", F.least(hi, last))
        .where("lo < hi")
        .select(
            "lo", "hi", F.col("temperature_f").alias("external_temperature_f"),
            F.explode(
                F.sequence(F.floor(F.col("lo") / (2 * bucket)), F.floor(F.col("hi") / (2 * bucket)))
            ).alias("bucket"),
        )
    )
    stamps = stamps.withColumn("bucket", F.floor(F.col("at") / bucket))
    return (
        stamps.join(served, "bucket")
        .where((2 * F.col("at") > F.col("lo")) & (2 * F.col("at") <= F.col("hi")))
        .select("timestamp", "external_temperature_f")
    )


def asof_temperature(readings: DataFrame, weather: DataFrame, tolerance_minutes: float | None = None) -> DataFrame:
    """Add external_temperature_f, the nearest temperature within the tolerance (none: unlimited).

    Temperature is of the site, so the nearest row is found once per distinct
    stamp and then joined to all meters by equality.
    """
    return readings.join(nearest_weather(readings, weather, tolerance_minutes), "timestamp", "left").select(
        *readings.columns, "external_temperature_f"
    )


def merge_temperature(
    readings: DataFrame,
    weather: DataFrame | None,
    tolerance_minutes: float | None = None,
    override: bool = False,
) -> DataFrame:
    """temperature_f from the weather: fills missing values only, or wins wherever it matched."""
    if weather is None:
        return readings
    matched = asof_temperature(readings, weather, tolerance_minutes)
    if "temperature_f" not in readings.columns:
        value = F.col("external_temperature_f")
    elif override:
        value = F.coalesce("external_temperature_f", "temperature_f")
    else:
        value = F.coalesce("temperature_f", "external_temperature_f")
    return matched.withColumn("temperature_f", value).drop("external_temperature_f")
