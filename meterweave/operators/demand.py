"""Demand classes, ramps and local extrema along an entity's load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterweave.functions.quantiles import exact_percentiles
from meterweave.plans.days import join_facts, with_date, with_neighbours

ENTITY = ["entity_id"]
KW = "demand_kw"


def _distinct(names: list[str]) -> list[str]:
    if len(set(names)) < len(names):
        raise ValueError(f"class names collide: {names}")
    return names


def meets(threshold: float) -> Column:
    return F.coalesce(F.col(KW) >= threshold, F.lit(False))


def class_threshold(load: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Add meets_threshold_<kW> per threshold; missing demand meets none."""
    names = _distinct([f"meets_threshold_{int(t)}" for t in thresholds])
    return load.withColumns({n: meets(t) for n, t in zip(names, thresholds)})


def class_percentile(load: DataFrame, percentiles: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Add top_pct_<p> per percentile: demand at or above the entity's exact percentile.

    accuracy is that of the sketch that narrows the search; the result is exact with any.
    """
    names = _distinct([f"top_pct_{round(p * 100)}" for p in percentiles])
    load = with_date(load)
    cutoffs = exact_percentiles(load, "entity_id", KW, percentiles, accuracy)
    flagged = join_facts(load, ENTITY, cutoffs).withColumns(
        {n: F.coalesce(F.col(KW) >= F.col("cutoffs")[i], F.lit(False)) for i, n in enumerate(names)}
    )
    return flagged.drop("cutoffs")


def class_rank(load: DataFrame, tops: Sequence[int]) -> DataFrame:
    """Add top_rank_<n> per n: among the n largest demands of the entity, earlier stamps first.

    Only the n largest per task are shuffled (Spark limits the window group
    before the shuffle); the rank cut-offs are then joined to all rows.
    """
    names = _distinct([f"top_rank_{n}" for n in tops])
    order = Window.partitionBy("entity_id").orderBy(F.desc(KW), F.asc("timestamp"))
    best = (
        load.where(F.col(KW).isNotNull())
        .select("entity_id", "timestamp", KW)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= max(tops))
    )
    last = F.struct("rank", KW, "timestamp")
    cuts = best.groupBy("entity_id").agg(
        *[F.max(F.when(F.col("rank") <= n, last)).alias(f"_{name}") for n, name in zip(tops, names)]
    )

    def within(name: str) -> Column:
        cut = F.col(f"_{name}")
        larger = F.col(KW) > cut[KW]
        same = (F.col(KW) == cut[KW]) & (F.col("timestamp") <= cut["timestamp"])
        return F.coalesce(larger | same, F.lit(False))

    flagged = join_facts(with_date(load), ENTITY, cuts).withColumns({n: within(n) for n in names})
    return flagged.drop(*[f"_{n}" for n in names])


def ramps(load: DataFrame) -> DataFrame:
    """Add ramp_kw and its positive and negative part; NULL next to a missing value."""
    rows = with_neighbours(load, ENTITY, KW, ("_before", "_after"))
    ramp = F.col("ramp_kw")
    return (
        rows.withColumn("ramp_kw", F.col(KW) - F.col("_before"))
        .withColumn("ramp_up_kw", F.when(ramp > 0, ramp).when(ramp.isNotNull(), 0.0))
        .withColumn("ramp_down_kw", F.when(ramp < 0, -ramp).when(ramp.isNotNull(), 0.0))
        .drop("_before", "_after")
    )


def local_extrema(rows: DataFrame) -> DataFrame:
    """Add is_peak and is_valley by strict comparison with both neighbours in the entity's series.

    The series runs across midnight. Ends and rows next to a missing value are neither.
    """
    near = with_neighbours(rows, ENTITY, KW, ("_before", "_after"))
    peak = (F.col(KW) > F.col("_before")) & (F.col(KW) > F.col("_after"))
    valley = (F.col(KW) < F.col("_before")) & (F.col(KW) < F.col("_after"))
    return (
        near.withColumn("is_peak", F.coalesce(peak, F.lit(False)))
        .withColumn("is_valley", F.coalesce(valley, F.lit(False)))
        .drop("_before", "_after")
    )
