"""Meter tables derived from the driver's tables.

A meter is a user of `events`; its demand is what the user's events sum to per
interval, stamped at the interval's end. The group tree comes from `customer`:
nations under regions under World, market segments across them, and a portfolio
without the customers in debt. Feeders are the event types, at 15 minutes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterweave.operators import entities, gaps, groups, profiles


Stage = Callable[[SparkSession, str], DataFrame]
_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def stage(build: Stage) -> Stage:
    """A table that several operators read: computed once per session, kept in memory or on disk.

    Lost blocks are computed again from the source tables.
    """

    @wraps(build)
    def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (build.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _STAGES:
            _STAGES[key] = build(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
        return _STAGES[key]

    return staged


def release() -> None:
    """Drop all stage tables."""
    for df in _STAGES.values():
        df.unpersist()
    _STAGES.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def meter_name(c: str) -> Column:
    return F.concat(F.lit("m"), F.col(c).cast("string"))


def at_minute(minute: Column) -> Column:
    """The naive stamp that many minutes into the day of ts; no time zone is involved."""
    return F.timestamp_add("MINUTE", minute, F.to_date("ts").cast("timestamp_ntz"))


def interval_end(minutes: int) -> Column:
    """End of the interval that holds ts, counted within its hour."""
    return at_minute(F.hour("ts") * 60 + (F.floor(F.minute("ts") / minutes) + 1) * minutes)


def temperature(ts: str) -> Column:
    """A fixed weather curve in whole degrees."""
    base = 35 + (F.day(ts) * 17) % 40 + (12 - F.abs(F.hour(ts) - 15))
    return base.cast("double")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly demand and temperature per user."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(meter_name("user_id").alias("meter_id"), interval_end(60).alias("timestamp"))
        .agg(F.round(F.sum("value"), 2).alias("demand_kw"))
        .withColumn("temperature_f", temperature("timestamp"))
    )


def feeders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-hourly demand per event type."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("meter_id"), interval_end(15).alias("timestamp"))
        .agg(F.round(F.sum("value"), 2).alias("demand_kw"))
    )


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per event under source names: repeated stamps and, by content, bad values."""
    stamp = F.date_format(interval_end(60), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        F.when(F.col("props") == '{"k": 13}', F.lit("not a time")).otherwise(stamp).alias("read_at"),
        F.when(F.col("props") != '{"k": 7}', meter_name("user_id")).alias("device"),
        F.when(F.col("value") > 250, F.lit("out of range"))
        .when(F.col("value") < 1, F.concat(F.lit("-"), F.col("value").cast("string")))
        .otherwise(F.col("value").cast("string"))
        .alias("kw"),
        F.col("event_id").alias("line"),
        F.col("event_type").alias("channel"),
    )


MAPPING = {"timestamp": "read_at", "meter_id": "device", "demand_kw": "kw"}


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly site temperature at the full hours that have events."""
    hours = table(spark, sf_dir, "events").select(at_minute(F.hour("ts") * 60).alias("timestamp"))
    return hours.distinct().withColumn("temperature_f", temperature("timestamp"))


def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(meter_name("c_custkey").alias("meter_id"))


def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    by_nation = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("group_name"), meter_name("c_custkey").alias("meter_id")
    )
    return by_nation.unionByName(
        customer.select(F.col("c_mktsegment").alias("group_name"), meter_name("c_custkey").alias("meter_id"))
    )


def group_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"))
        .unionByName(region.select(F.lit("World").alias("parent"), F.col("r_name").alias("child")))
    )


def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal < 0").select(meter_name("c_custkey").alias("meter_id"))


@stage
def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = meters(spark, sf_dir)
    resolved = groups.resolve_groups(group_members(spark, sf_dir), group_children(spark, sf_dir))
    portfolio = groups.portfolio_members(listed, excluded(spark, sf_dir))
    return groups.entity_members(listed, resolved, portfolio)


def joint_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of groups and portfolio only."""
    return members(spark, sf_dir).where("entity_type <> 'meter'")


@stage
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.fill_gaps(readings(spark, sf_dir), 60)


@stage
def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.entity_load(observations(spark, sf_dir), members(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.daily_profiles(load(spark, sf_dir), 60)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.daily_features(daily(spark, sf_dir), 60)
