"""How meters coincide in the peaks of the entities they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from meterweave.plans.days import join_facts, with_date

KW = "analysis_demand_kw"


METER = ["meter_id"]


def _pairs(members: DataFrame) -> DataFrame:
    return members.select("entity_id", "meter_id").distinct()


def _rows(observations: DataFrame) -> DataFrame:
    return with_date(observations).select("meter_id", "date", "timestamp", KW)


def _aggregate(observations: DataFrame, members: DataFrame) -> DataFrame:
    joined = join_facts(_rows(observations), METER, _pairs(members), "inner")
    return joined.groupBy("entity_id", "timestamp").agg(F.sum(KW).alias("aggregate_demand_kw"))


def _peaks(observations: DataFrame) -> DataFrame:
    return observations.groupBy("meter_id").agg(F.max(KW).alias("peak"))


def peak_contribution(observations: DataFrame, members: DataFrame, top_n: int = 10) -> DataFrame:
    """Each member's demand and share at the entity's `top_n` stamps by summed demand.

    Equal sums are taken in order of time. A member without a value keeps its row
    with NULLs, a member without a row at the stamp has none. The top stamps are
    given to the members, which look up only these.
    """
    order = Window.partitionBy("entity_id").orderBy(F.desc_nulls_last("aggregate_demand_kw"), "timestamp")
    top = (
        _aggregate(observations, members)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_n)
        .drop("rank")
    )
    wanted = top.join(_pairs(members), "entity_id")
    share = F.when(
        F.col("aggregate_demand_kw") != 0, F.col("meter_demand_kw") / F.col("aggregate_demand_kw") * 100
    )
    return (
        _rows(observations)
        .withColumnRenamed(KW, "meter_demand_kw")
        .join(wanted, ["meter_id", "timestamp"])
        .select(
            "entity_id", "timestamp", "aggregate_demand_kw", "meter_id", "meter_demand_kw",
            share.alias("pct_contribution"),
        )
    )


def interval_coincidence(
    observations: DataFrame, members: DataFrame, share_of_peak: float = 0.9
) -> DataFrame:
    """Per member: stamps near its own peak, and how many of them some other member shares.

    Only rows near a peak are joined to the entities and counted per stamp. A
    member that never reports has a row of zeros.
    """
    pairs = _pairs(members)
    near = (
        join_facts(_rows(observations), METER, _peaks(observations), "inner")
        .where(F.col(KW) >= share_of_peak * F.col("peak"))
        .select("meter_id", "timestamp")
        .join(pairs, "meter_id")
    )
    shared = (
        near.groupBy("entity_id", "timestamp")
        .agg(F.count(F.lit(1)).alias("n_near"))
        .where("n_near > 1")
        .withColumn("shared", F.lit(1))
    )
    counts = (
        near.join(shared, ["entity_id", "timestamp"], "left")
        .groupBy("entity_id", "meter_id")
        .agg(F.count(F.lit(1)).alias("near"), F.count("shared").alias("coincident"))
    )
    return pairs.join(counts, ["entity_id", "meter_id"], "left").select(
        "entity_id", "meter_id",
        F.coalesce("near", F.lit(0)).alias("n_near_peak_intervals"),
        F.coalesce("coincident", F.lit(0)).alias("n_coincident_with_any_other"),
        F.bround(F.col("coincident") / F.when(F.col("near") > 0, F.col("near")), 3).alias("coincidence_rate"),
    )


def diversity_factor(observations: DataFrame, members: DataFrame) -> DataFrame:
    """Sum of the members' peaks over the peak of their sum, per entity."""
    own = _pairs(members).join(_peaks(observations), "meter_id").groupBy("entity_id").agg(
        F.coalesce(F.sum("peak"), F.lit(0.0)).alias("sum_of_individual_peaks_kw")
    )
    joint = _aggregate(observations, members).groupBy("entity_id").agg(
        F.max("aggregate_demand_kw").alias("aggregate_peak_kw")
    )
    return own.join(joint, "entity_id").withColumn(
        "diversity_factor",
        F.when(F.col("aggregate_peak_kw") > 0, F.col("sum_of_individual_peaks_kw") / F.col("aggregate_peak_kw")),
    )
