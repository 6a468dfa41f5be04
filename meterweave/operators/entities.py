"""Load of meters, groups and the portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterweave import schema
from meterweave.plans.days import by_day, join_facts, with_date

ENTITY = ["entity_id"]


def entity_load(
    observations: DataFrame, members: DataFrame, demand: str = "analysis_demand_kw"
) -> DataFrame:
    """(entity_id, entity_type, date, timestamp, demand_kw, n_meters_reporting), laid out by day.

    A single meter is its own series and passes through. Groups are summed over
    the members that report; a stamp where none does is NULL. Observations stay
    where they lie: members come to their days, and sums are formed per task
    before the shuffle, so a portfolio of all meters is no hot key.
    """
    rows = with_date(observations).select("meter_id", "date", "timestamp", F.col(demand).alias("demand_kw"))
    single = members.where(F.col("entity_type") == schema.METER)
    alone = join_facts(rows, ["meter_id"], single, "inner").select(
        "entity_id", "entity_type", "date", "timestamp", "demand_kw",
        F.col("demand_kw").isNotNull().cast("long").alias("n_meters_reporting"),
    )
    rolled = (
        join_facts(rows, ["meter_id"], members.where(F.col("entity_type") != schema.METER), "inner")
        .groupBy("entity_id", "entity_type", "date", "timestamp")
        .agg(F.sum("demand_kw").alias("demand_kw"), F.count("demand_kw").alias("n_meters_reporting"))
    )
    return by_day(alone.unionByName(rolled), ENTITY)
