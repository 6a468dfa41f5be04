"""Sampling interval of each meter."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterweave.functions import clock
from meterweave.plans.days import placed, with_neighbours

RESOLUTION = ["meter_id"]


def detect_resolution(readings: DataFrame) -> DataFrame:
    """Per meter: usual interval in minutes, deviating steps, duplicate stamps.

    A step is the distance between consecutive distinct stamps, in whole
    minutes; the most frequent step wins, the smaller one on a tie. A meter with
    one stamp has no interval.
    """
    stamps = placed(readings, RESOLUTION).groupBy("meter_id", "date", "timestamp").agg(
        (F.count(F.lit(1)) - 1).alias("extra")
    )
    stamps = stamps.withColumn("at", clock.micros(F.col("timestamp")))
    stepped = with_neighbours(stamps, RESOLUTION, "at", ("previous", "following"))
    minutes = F.bround((F.col("at") - F.col("previous")) / clock.MINUTE, 0).cast("int")
    steps = stepped.groupBy("meter_id", minutes.alias("minutes")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("extra").alias("extra")
    )
    known = F.when(F.col("minutes").isNotNull(), F.col("n"))
    usual = F.when(F.col("minutes").isNotNull(), F.struct(-F.col("n"), F.col("minutes")))
    return steps.groupBy("meter_id").agg(
        F.min_by("minutes", usual).alias("interval_minutes"),
        F.coalesce(F.sum(known) - F.max(known), F.lit(0)).alias("n_irregular_gaps"),
        F.sum("extra").alias("n_duplicate_timestamps"),
    )


def overall_resolution(per_meter: DataFrame) -> DataFrame:
    """One row over all meters: the most frequent interval, whether intervals are mixed, totals."""
    votes = per_meter.groupBy("interval_minutes").agg(
        F.count(F.lit(1)).alias("meters"),
        F.sum("n_irregular_gaps").alias("n_irregular_gaps"),
        F.sum("n_duplicate_timestamps").alias("n_duplicate_timestamps"),
    )
    known = F.col("interval_minutes").isNotNull()
    return votes.agg(
        F.min_by("interval_minutes", F.when(known, F.struct(-F.col("meters"), "interval_minutes"))).alias(
            "expected_interval_minutes"
        ),
        (F.count_if(known) > 1).alias("is_mixed_resolution"),
        F.sum("n_irregular_gaps").alias("n_irregular_gaps"),
        F.sum("n_duplicate_timestamps").alias("n_duplicate_timestamps"),
    )


def interval_minutes(readings: DataFrame, resolution: str = "auto") -> int:
    """The interval as a number: configured ("15min"), or detected by one small action."""
    if resolution != "auto":
        if not (resolution.endswith("min") and resolution[:-3].isdigit()):
            raise ValueError(f"unknown resolution: {resolution}")
        return int(resolution[:-3])
    detected = overall_resolution(detect_resolution(readings)).first()
    if detected is None or detected.expected_interval_minutes is None:
        raise ValueError("no sampling interval can be detected")
    return detected.expected_interval_minutes
