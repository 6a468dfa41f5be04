"""Recurring peak times, recurring shapes and outlier days.

All inputs have one row per (entity, date); a group of them is bounded by the
number of calendar days, also where it is gathered into a list of dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from meterweave.functions import clock


def _numbered_groups(days: DataFrame, group: str) -> DataFrame:
    """Per (entity, group): frequency, dates, total days, and number in order of the group value.

    All groups are numbered, also those a pattern drops later.
    """
    entity = Window.partitionBy("entity_id")
    groups = days.groupBy("entity_id", group).agg(
        F.count(F.lit(1)).alias("frequency"), F.sort_array(F.collect_list("date")).alias("dates")
    )
    return groups.select(
        "*",
        F.sum("frequency").over(entity).alias("n_days"),
        (F.row_number().over(entity.orderBy(group)) - 1).alias("number"),
    )


def _support():
    return F.bround(F.col("frequency") / F.col("n_days"), 3).alias("statistical_support")


def recurring_peak_timing(
    features: DataFrame, min_occurrences: int = 3, window_minutes: int = 30
) -> DataFrame:
    """Times of day, rounded down to the window, at which the peak of complete days recurs."""
    days = features.where(F.col("is_complete_day") & F.col("peak_minute").isNotNull()).withColumn(
        "bucket", (F.floor(F.col("peak_minute") / window_minutes) * window_minutes).cast("int")
    )
    groups = _numbered_groups(days, "bucket").where(F.col("frequency") >= min_occurrences)
    at = clock.hhmm(F.col("bucket"))
    return groups.select(
        "entity_id",
        F.format_string("%s_peak_timing_%03d", "entity_id", "number").alias("pattern_id"),
        F.lit("recurring_peak_timing").alias("pattern_type"),
        F.format_string("Daily peak recurs near %s on %d of %d complete days", at, "frequency", "n_days").alias(
            "description"
        ),
        "frequency", "dates",
        at.alias("representative_peak_time"),
        _support(),
    )


def recurring_shapes(shapes: DataFrame, min_occurrences: int = 3) -> DataFrame:
    """Primary shapes on at least `min_occurrences` days; days without enough data count in the total."""
    groups = _numbered_groups(shapes, "primary_shape").where(
        (F.col("frequency") >= min_occurrences) & (F.col("primary_shape") != "insufficient_data")
    )
    return groups.select(
        "entity_id",
        F.format_string("%s_shape_%03d", "entity_id", "number").alias("pattern_id"),
        F.lit("recurring_shape").alias("pattern_type"),
        F.format_string("'%s' shape recurs on %d of %d days", "primary_shape", "frequency", "n_days").alias(
            "description"
        ),
        "frequency", "dates",
        F.col("primary_shape").alias("shape"),
        _support(),
    )


def outlier_days(features: DataFrame, z_threshold: float = 2.5, min_days: int = 5) -> DataFrame:
    """Complete days whose energy or maximum lies at least `z_threshold` deviations off the entity's mean."""
    metrics = ("daily_energy_kwh", "maximum_demand_kw")
    days = features.where("is_complete_day").select(
        "entity_id", "date",
        F.posexplode(F.array(*metrics)).alias("metric_no", "value"),
    )
    spread = days.groupBy("entity_id", "metric_no").agg(
        F.count(F.lit(1)).alias("n_days"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd")
    ).where((F.col("n_days") >= min_days) & (F.col("sd") > 0))
    z = (F.col("value") - F.col("mean")) / F.col("sd")
    found = (
        days.join(spread, ["entity_id", "metric_no"])
        .withColumn("z", z)
        .where(F.abs("z") >= z_threshold)
        .withColumn("metric", F.element_at(F.array(*map(F.lit, metrics)), F.col("metric_no") + 1))
    )
    order = Window.partitionBy("entity_id").orderBy("metric_no", "date")
    return found.select(
        "entity_id",
        F.format_string("%s_outlier_%03d", "entity_id", F.row_number().over(order) - 1).alias("pattern_id"),
        F.lit("outlier_day").alias("pattern_type"),
        F.format_string("%s is an outlier on %s (z=%.2f)", F.col("date").cast("string"), "metric", "z").alias(
            "description"
        ),
        "date", "metric", "value",
        F.bround("z", 3).alias("z_score"),
        F.lit(f"z >= {z_threshold}").alias("statistical_support"),
    )
