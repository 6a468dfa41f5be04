"""Rule-based day shapes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from meterweave import schema
from meterweave.operators.features import segment_aggregates

# Default thresholds.
THRESHOLDS = {
    "flat_cv_max": 0.15,
    "highly_peaked_ratio_min": 2.0,
    "sharp_peak_width_frac_max": 0.10,
    "sustained_high_frac_min": 0.30,
    "sustained_high_pct_of_peak": 0.90,
    "overnight_heavy_ratio_min": 1.1,
    "multi_peak_min_count": 2,
}
SEGMENT_SHARE_OF_PEAK = 0.85
MIN_SHARE_PRESENT = 0.5

FLAGS = (
    "is_flat", "is_highly_peaked", "has_morning_peak", "has_midday_peak", "has_afternoon_peak",
    "has_evening_peak", "is_overnight_heavy", "is_multi_peak", "has_sharp_peak",
    "has_sustained_high_load", "has_peak_valley_pattern", "is_unusual",
)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def day_shapes(
    profiles: DataFrame, features: DataFrame, thresholds: Mapping[str, float] | None = None
) -> DataFrame:
    """Twelve flags and the primary shape per (entity, date) that has features.

    Uses is_peak / is_valley of the profiles if they are there. Profiles and
    features are both laid out by (entity, date): neither the join nor the
    aggregation after it moves the intervals.
    """
    th = {**THRESHOLDS, **(thresholds or {})}
    has_extrema = {"is_peak", "is_valley"} <= set(profiles.columns)
    kw = F.col("demand_kw")
    facts = features.select(
        "entity_id", "date", "maximum_demand_kw", "peak_to_average_ratio", "coefficient_of_variation"
    )
    rows = profiles.join(facts, ["entity_id", "date"])
    high = kw >= th["sustained_high_pct_of_peak"] * F.col("maximum_demand_kw")
    extrema = (
        [F.count_if("is_peak").alias("n_peaks"), F.count_if("is_valley").alias("n_valleys")] if has_extrema else []
    )
    days = rows.groupBy(
        "entity_id", "date", "maximum_demand_kw", "peak_to_average_ratio", "coefficient_of_variation"
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(kw).alias("n_present"),
        F.max(kw).alias("day_max"),
        F.count_if(high).alias("n_high"),
        *segment_aggregates(),
        *extrema,
    )
    days = days.withColumns(
        {
            f"has_{name}_peak": _true(
                (F.col("day_max") > 0) & (F.col(f"{name}_peak_kw") >= SEGMENT_SHARE_OF_PEAK * F.col("day_max"))
            )
            for name in schema.SEGMENTS
        }
    )
    if has_extrema:
        n_peaks = F.col("n_peaks")
        both = (F.col("n_peaks") >= 1) & (F.col("n_valleys") >= 1)
    else:
        n_peaks = sum((F.col(f"has_{name}_peak").cast("int") for name in schema.SEGMENTS), F.lit(0))
        both = F.lit(False)
    width = F.when(F.col("maximum_demand_kw") > 0, F.col("n_high") / F.col("n_rows"))
    night_share = F.when(
        F.col("daytime_mean_kw") > 0, F.col("overnight_mean_kw") / F.col("daytime_mean_kw")
    )
    days = days.withColumns(
        {
            "is_flat": _true(F.col("coefficient_of_variation") <= th["flat_cv_max"]),
            "is_highly_peaked": _true(F.col("peak_to_average_ratio") >= th["highly_peaked_ratio_min"]),
            "is_overnight_heavy": _true(night_share >= th["overnight_heavy_ratio_min"]),
            "is_multi_peak": n_peaks >= th["multi_peak_min_count"],
            "has_sharp_peak": _true(width <= th["sharp_peak_width_frac_max"]),
            "has_sustained_high_load": _true(width >= th["sustained_high_frac_min"]),
            "has_peak_valley_pattern": both,
            "is_unusual": F.col("n_present") / F.col("n_rows") < MIN_SHARE_PRESENT,
        }
    )
    return days.select("entity_id", "date", *FLAGS, primary_shape().alias("primary_shape"))


def primary_shape() -> Column:
    """The first matching rule names the day."""
    single = F.col("is_highly_peaked") & F.col("has_sharp_peak")
    morning, midday = F.col("has_morning_peak"), F.col("has_midday_peak")
    afternoon, evening = F.col("has_afternoon_peak"), F.col("has_evening_peak")
    return (
        F.when(F.col("is_unusual"), "insufficient_data")
        .when(single & morning & ~afternoon & ~evening, "morning_peak")
        .when(single & afternoon & ~evening, "afternoon_peak")
        .when(single & evening, "evening_peak")
        .when(single & midday, "midday_peak")
        .when(F.col("is_multi_peak"), "multi_peak")
        .when(F.col("is_overnight_heavy"), "overnight_heavy")
        .when(F.col("is_flat"), "flat")
        .otherwise("mixed_other")
    )
