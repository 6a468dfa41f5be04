"""Counts over all stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _counts(rows: DataFrame, section: str, entity, label) -> DataFrame:
    return (
        rows.groupBy(entity.alias("entity_id"), label.alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(section).alias("section"), "entity_id", "label", "n")
    )


def stage_summary(
    features: DataFrame, observations: DataFrame, events: DataFrame, shapes: DataFrame, patterns: list[DataFrame]
) -> DataFrame:
    """(section, entity_id, label, n): complete days, quality flags, events, shapes, patterns."""
    complete = F.when(F.col("is_complete_day"), "complete").otherwise("incomplete")
    entity = F.col("entity_id")
    parts = [
        _counts(features, "days", entity, complete),
        _counts(observations, "quality", F.lit(None).cast("string"), F.col("data_quality_flag")),
        _counts(events, "peak_events", entity, F.col("peak_definition")),
        _counts(shapes, "primary_shape", entity, F.col("primary_shape")),
        *[_counts(p, "patterns", entity, F.col("pattern_type")) for p in patterns],
    ]
    return reduce(DataFrame.unionByName, parts)
