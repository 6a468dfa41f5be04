"""Gap-tolerant peak events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterweave.functions import clock
from meterweave.plans.days import in_day, join_day_state, per_series, placed

ENTITY = ["entity_id"]


def peak_events(load: DataFrame, qualifies: Column, allowed_gap: int, definition: str) -> DataFrame:
    """Merge qualifying rows with at most `allowed_gap` other rows between them into events.

    An event covers all rows from its first to its last qualifying row. Gaps are
    counted in rows, not in time, and an event may span days; its duration is
    end minus start, so a single row lasts 0 hours. Row numbers and event numbers
    are counted inside each day; the day summary carries the totals of the days
    before, the last qualifying row before and the first one after.
    """
    day = in_day(ENTITY)
    rows = placed(load, ENTITY).select(
        "entity_id", "date", "timestamp", "demand_kw",
        F.coalesce(qualifies, F.lit(False)).alias("q"),
        F.row_number().over(day).alias("place"),
    )
    hit = F.when(F.col("q"), F.col("place"))
    upto = day.rowsBetween(Window.unboundedPreceding, 0)
    before = day.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("hit_before", F.last(hit, True).over(before))
    # A qualifying row that surely opens an event within its day; the first one of a day is decided below.
    rows = rows.withColumn(
        "opens", (F.col("q") & (F.col("place") - F.col("hit_before") - 1 > allowed_gap)).cast("long")
    )
    days = rows.groupBy("entity_id", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(hit).alias("first_hit"),
        F.max(hit).alias("last_hit"),
        F.coalesce(F.sum("opens"), F.lit(0)).alias("n_opens"),
    )
    earlier, later = per_series(ENTITY), per_series(ENTITY, descending=True)
    days = days.withColumn("rows_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    days = days.withColumn(
        "last_before", F.last(F.col("rows_before") + F.col("last_hit"), True).over(earlier)
    )
    distance = F.col("rows_before") + F.col("first_hit") - F.col("last_before") - 1
    days = days.withColumn(
        "first_opens",
        F.when(F.col("first_hit").isNull(), 0)
        .when(F.col("last_before").isNull() | (distance > allowed_gap), 1)
        .otherwise(0),
    )
    days = days.withColumn(
        "events_before",
        F.coalesce(F.sum(F.col("first_opens") + F.col("n_opens")).over(earlier), F.lit(0)),
    )
    first_event = F.when(F.col("first_hit").isNotNull(), F.col("events_before") + F.col("first_opens"))
    days = days.select(
        "entity_id", "date", "events_before", "first_opens",
        F.last(first_event, True).over(later).alias("event_after"),
    )
    # Events are numbered from 1 here; 0 means none so far.
    opened = F.sum("opens").over(upto)
    below = in_day(ENTITY, descending=True).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("opened", F.coalesce(opened, F.lit(0))).withColumn(
        "hit_yet", F.max("q").over(upto)
    )
    rows = join_day_state(rows, ENTITY, days)
    rows = rows.withColumn(
        "event_upto",
        F.col("events_before") + F.when(F.col("hit_yet"), F.col("first_opens") + F.col("opened")).otherwise(0),
    )
    rows = rows.withColumn(
        "event_from",
        F.coalesce(F.last(F.when(F.col("q"), F.col("event_upto")), True).over(below), F.col("event_after")),
    )
    events = (
        rows.where((F.col("event_upto") == F.col("event_from")))
        .groupBy("entity_id", F.col("event_upto").alias("number"))
        .agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.max("demand_kw").alias("maximum_demand_kw"),
            F.avg("demand_kw").alias("mean_demand_kw"),
            F.min("demand_kw").alias("minimum_demand_kw"),
            F.count(F.lit(1)).alias("n_intervals"),
        )
    )
    return events.select(
        F.format_string(f"%s_{definition.replace('%', '%%')}_%04d", "entity_id", F.col("number") - 1).alias("event_id"),
        "entity_id",
        F.lit(definition).alias("peak_definition"),
        "start_time", "end_time",
        hours_between("start_time", "end_time").alias("duration_hours"),
        "maximum_demand_kw", "mean_demand_kw", "minimum_demand_kw", "n_intervals",
    )


def hours_between(start: str, end: str) -> Column:
    return (clock.micros(F.col(end)) - clock.micros(F.col(start))) / (60 * clock.MINUTE)


def event_duration_class(events: DataFrame, sustained_hours: float) -> DataFrame:
    return events.withColumn(
        "duration_class", F.when(F.col("duration_hours") >= sustained_hours, "sustained").otherwise("short")
    )
