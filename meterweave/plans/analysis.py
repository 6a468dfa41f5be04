"""The whole analysis: raw readings to result tables.

The source is read once: the readings without duplicates are staged, and so are
two tables that many operators read, the filled observations and the load of
all entities. Staged means: kept by Spark, or written to a folder that all
executors share and read back, which also cuts the plan. All other steps are
lazy DataFrames over them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from meterweave.operators import (
    calendar, changepoint, clusters, coincidence, demand, entities, events, features, gaps, groups, patterns,
    profiles, quality, resolution, shapes, summary, validation, weather,
)
from meterweave.sources import readings as sources

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Settings:
    """Parameters of an analysis, with the usual values."""

    mapping: Mapping[str, str] | None = None
    timestamp_pattern: str | list[str] | None = None
    severities: Mapping[str, str] | None = None
    strict: bool = False
    ordinal: str | None = None
    resolution: str = "auto"
    fill_limit: int = 4
    fill_enabled: bool = True
    fill_method: str = "linear"
    forward_fill: bool = False
    backward_fill: bool = False
    weather_tolerance_minutes: float | None = None
    weather_overrides: bool = False
    holidays: Sequence[str] = ()
    seasons: Mapping[int, str] | None = None
    thresholds_kw: Sequence[float] = (500.0, 750.0, 1000.0)
    percentiles: Sequence[float] = (0.99, 0.95)
    top_ranks: Sequence[int] = (10, 25, 50)
    allowed_gap: int = 1
    sustained_hours: float = 2.0
    bands_f: Sequence[float] = (32, 50, 65, 80, 90)
    cluster_count: int | str = "auto"


@dataclass(frozen=True)
class Sites:
    """Meters and their groups, see meterweave.operators.groups."""

    meters: DataFrame
    group_members: DataFrame
    group_children: DataFrame
    excluded: DataFrame


def keep(df: DataFrame, name: str) -> DataFrame:
    """Stage in memory and on disk; lost blocks are computed again."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def written(folder: str) -> Stage:
    """Stage as parquet tables below a shared folder."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return df.sparkSession.read.parquet(f"{folder}/{name}")

    return stage


def prepare(
    raw: DataFrame, settings: Settings, site_weather: DataFrame | None = None, stage: Stage = keep
) -> tuple[DataFrame, int, DataFrame]:
    """Observations on the regular grid, the interval in minutes, and the findings.

    Raises on fatal findings; duplicates are reported and removed. With the
    pattern "auto" times are read as most of them can be; a second way to read
    them is a finding.
    """
    mapped, pattern = sources.map_columns(raw, settings.mapping or {}), settings.timestamp_pattern
    notes = None
    if pattern == "auto":
        notes = sources.ambiguous_findings(sources.timestamp_patterns(mapped))
        mapped, pattern = sources.with_found_timestamps(mapped), None
    rows, findings = validation.counted_readings(mapped, stage, settings.ordinal, settings.severities, pattern)
    findings = findings if notes is None else findings.unionByName(notes)
    validation.raise_if_fatal(findings, settings.strict)
    rows = weather.merge_temperature(
        rows, site_weather, settings.weather_tolerance_minutes, settings.weather_overrides
    )
    minutes = resolution.interval_minutes(rows, settings.resolution)
    filled = gaps.fill_gaps(
        rows, minutes, settings.fill_limit, settings.fill_enabled, settings.fill_method,
        settings.forward_fill, settings.backward_fill,
    )
    observations = calendar.calendar_features(filled, settings.holidays, settings.seasons)
    observations = calendar.interval_energy(observations, minutes)
    return stage(observations, "observations"), minutes, findings


def analyze(
    observations: DataFrame, minutes: int, sites: Sites, settings: Settings, stage: Stage = keep
) -> dict[str, DataFrame]:
    """All result tables, by name; each covers all entities (or meters) at once."""
    resolved = groups.resolve_groups(sites.group_members, sites.group_children)
    portfolio = groups.portfolio_members(sites.meters, sites.excluded)
    members = stage(groups.entity_members(sites.meters, resolved, portfolio), "entity_members")
    joint = members.where("entity_type <> 'meter'")
    load = stage(entities.entity_load(observations, members), "entity_load")
    daily = profiles.daily_profiles(load, minutes)
    found = stage(profiles.daily_features(daily, minutes), "daily_features")
    shaped = stage(shapes.day_shapes(demand.local_extrema(daily), found), "day_shapes")
    classed = demand.class_threshold(load, settings.thresholds_kw)
    classed = demand.class_percentile(classed, settings.percentiles)
    classed = demand.class_rank(classed, settings.top_ranks)
    first = settings.thresholds_kw[0]
    peaks = events.event_duration_class(
        events.peak_events(load, demand.meets(first), settings.allowed_gap, f"threshold_{first:g}"),
        settings.sustained_hours,
    )
    timing, recurring = patterns.recurring_peak_timing(found), patterns.recurring_shapes(shaped)
    outliers = patterns.outlier_days(found)
    # Clusters and patterns are wanted for meters and the portfolio; groups come at no extra pass.
    clustered = clusters.cluster_days(clusters.day_vectors(daily), settings.cluster_count)
    tables = {
        "observations": observations,
        "quality_summary": quality.quality_summary(observations),
        "quality_detail": quality.quality_detail(observations),
        "entity_members": members,
        "entity_load": load,
        "daily_profiles": profiles.normalized_profiles(daily),
        "daily_features": found,
        "day_coverage": profiles.day_coverage(load, members, minutes),
        "segment_features": features.segment_features(daily),
        "demand_classes": classed,
        "ramps": demand.local_extrema(demand.ramps(load)),
        "peak_events": peaks,
        "day_shapes": shaped,
        "clusters": clusters.cluster_summary(clustered),
        "cluster_days": clustered.drop("vector"),
        "cluster_choice": clusters.cluster_choice(clustered),
        "timing_patterns": timing,
        "shape_patterns": recurring,
        "outlier_days": outliers,
        "peak_contribution": coincidence.peak_contribution(observations, joint),
        "interval_coincidence": coincidence.interval_coincidence(observations, joint),
        "diversity_factor": coincidence.diversity_factor(observations, joint),
        "stage_summary": summary.stage_summary(found, observations, peaks, shaped, [timing, recurring, outliers]),
    }
    if "temperature_f" in observations.columns:
        points = features.weekday_daily_means(observations)
        tables["daily_temperature"] = features.entity_temperature(observations, members)
        tables["temperature_bands"] = features.temperature_bands(
            observations.select("meter_id", "timestamp", "temperature_f"), settings.bands_f
        )
        tables["change_points"] = changepoint.select_model(points)
    return tables
