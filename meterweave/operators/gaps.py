"""Regular grid per meter and gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterweave import schema
from meterweave.functions import clock
from meterweave.plans.days import by_day, placed, with_known_around

KEYS = ["meter_id"]
AT = "minute_index"


def regular_grid(readings: DataFrame, interval_minutes: int) -> DataFrame:
    """(meter_id, date, timestamp): every expected interval from a meter's first to last stamp.

    The span of a meter is first cut into days, the days are spread over the
    cluster, and only there each day becomes its intervals.
    """
    step = interval_minutes * clock.MINUTE
    days = (
        readings.groupBy("meter_id")
        .agg(F.min("timestamp").alias("start"), F.max("timestamp").alias("end"))
        .where("start is not null")
        .withColumn("date", F.explode(F.sequence(F.to_date("start"), F.to_date("end"))))
    )
    days = by_day(days, KEYS, to_expand=True)
    origin = clock.micros(F.col("start"))
    into_day = F.unix_date("date").cast("long") * clock.DAY - origin
    last_slot = F.floor((clock.micros(F.col("end")) - origin) / step)
    first = F.greatest(F.lit(0).cast("long"), F.ceil(into_day / step))
    last = F.least(last_slot, F.ceil((into_day + clock.DAY) / step) - 1)
    return (
        days.withColumn("lo", first)
        .withColumn("hi", last)
        .where("lo <= hi")
        .withColumn("slot", F.explode(F.sequence("lo", "hi")))
        .select(
            "meter_id", "date",
            clock.plus_micros(F.col("start"), F.col("slot") * step).alias("timestamp"),
        )
    )


def on_grid(readings: DataFrame, interval_minutes: int) -> DataFrame:
    """Readings put on the grid: absent intervals become rows of NULLs, off-grid rows go.

    Grid and readings are both laid out by (meter_id, date) and merged by one
    aggregation there; a join on the timestamp would need another shuffle. Of
    several readings at one stamp a whole one stays, the lowest known demand.
    """
    readings = placed(readings.where(F.col("timestamp").isNotNull()), KEYS)
    keys = ["meter_id", "date", "timestamp"]
    carried = [c for c in readings.columns if c not in keys]
    rest = sorted(carried, key=lambda c: c != "demand_kw")
    order = F.struct(F.col("_expected").isNotNull(), F.col("demand_kw").isNull(), *rest)
    grid = regular_grid(readings, interval_minutes).withColumn("_expected", F.lit(True))
    return (
        grid.unionByName(by_day(readings, KEYS, to_expand=True), allowMissingColumns=True)
        .groupBy(*keys)
        .agg(F.max("_expected").alias("_expected"), F.min_by(F.struct(*carried), order).alias("_kept"))
        .where("_expected")
        .select(*keys, *[F.col(f"_kept.{c}") for c in carried])
    )


def off_grid_readings(readings: DataFrame, interval_minutes: int) -> DataFrame:
    """Readings that gap filling drops because they are off their meter's grid."""
    step = interval_minutes * clock.MINUTE
    starts = readings.groupBy("meter_id").agg(F.min("timestamp").alias("_start"))
    offset = clock.micros(F.col("timestamp")) - clock.micros(F.col("_start"))
    return readings.join(starts, "meter_id").where(offset % step != 0).drop("_start")


def _steps(later: str, earlier: str, interval_minutes: int) -> Column:
    return (F.col(later) - F.col(earlier)) / interval_minutes


def _between_known(c: str, interval_minutes: int, limit: int) -> Column:
    """Linear value inside a gap, for the first `limit` rows of the gap only."""
    position = _steps(AT, f"{c}_prev_at", interval_minutes)
    length = _steps(f"{c}_next_at", f"{c}_prev_at", interval_minutes)
    rise = F.col(f"{c}_next") - F.col(f"{c}_prev")
    return F.when((position <= limit) & (length > 0), F.col(f"{c}_prev") + rise * position / length)


def _forward(c: str, interval_minutes: int, limit: int) -> Column:
    """The last filled value, repeated for up to `limit` more rows."""
    position = _steps(AT, f"{c}_prev_at", interval_minutes)
    length = _steps(f"{c}_next_at", f"{c}_prev_at", interval_minutes)
    rise = F.col(f"{c}_next") - F.col(f"{c}_prev")
    repeated = F.col(f"{c}_prev") + rise * limit / length
    return F.when(length.isNull(), F.when(position <= limit, F.col(f"{c}_prev"))).when(
        (position <= 2 * limit) & (length > 0), repeated
    )


def _backward(c: str, interval_minutes: int, limit: int) -> Column:
    """The next known value, for up to `limit` rows before it."""
    distance = _steps(f"{c}_next_at", AT, interval_minutes)
    return F.when(distance <= limit, F.col(f"{c}_next"))


def fill_gaps(
    readings: DataFrame,
    interval_minutes: int,
    limit: int = 4,
    enabled: bool = True,
    method: str = "linear",
    forward: bool = False,
    backward: bool = False,
) -> DataFrame:
    """Observed, interpolated and analysis demand on the regular grid, with quality flags.

    Only the first `limit` rows of a gap are interpolated, on the slope of the
    whole gap; the rest stays missing. Forward and backward fill work on what
    interpolation left. On a regular grid the methods "linear" and "time" agree.
    A limit of 0 fills nothing. Of several readings of a meter at one stamp one
    stays as a whole: the lowest known demand, ties by the other columns.
    """
    if method not in ("linear", "time"):
        raise ValueError(f"unknown interpolation method: {method}")
    if limit < 0:
        raise ValueError("limit must not be negative")
    rows = on_grid(readings, interval_minutes)
    has_temperature = "temperature_f" in rows.columns
    filled = F.col("demand_kw")
    if enabled:
        columns = ["demand_kw"] + (["temperature_f"] if has_temperature else [])
        rows = placed(rows, KEYS).withColumn(AT, clock.minutes(F.col("timestamp")))
        rows = with_known_around(rows, KEYS, columns, order=AT)
        steps = [filled, _between_known("demand_kw", interval_minutes, limit)]
        if forward:
            steps.append(_forward("demand_kw", interval_minutes, limit))
        if backward:
            steps.append(_backward("demand_kw", interval_minutes, limit))
        filled = F.coalesce(*steps)
        if has_temperature:
            rows = rows.withColumn(
                "temperature_f",
                F.coalesce("temperature_f", _between_known("temperature_f", interval_minutes, limit)),
            )
    observed = F.col("demand_kw").isNotNull()
    rows = (
        rows.withColumn("analysis_demand_kw", filled)
        .withColumn("observed_demand_kw", F.col("demand_kw"))
        .withColumn("interpolated_demand_kw", F.when(~observed, F.col("analysis_demand_kw")))
        .withColumn("is_observed", observed)
        .withColumn("is_interpolated", ~observed & F.col("analysis_demand_kw").isNotNull())
        .withColumn(
            "data_quality_flag",
            F.when(F.col("is_observed"), schema.OBSERVED)
            .when(F.col("is_interpolated"), schema.INTERPOLATED)
            .otherwise(schema.MISSING),
        )
    )
    helper = [f"{c}_{s}" for c in ("demand_kw", "temperature_f") for s in ("prev_at", "prev", "next_at", "next")]
    return rows.drop("demand_kw", AT, *helper)


def observed_and_runs(observations: DataFrame) -> DataFrame:
    """Per meter one row for all observed intervals and one per run of non-observed ones.

    All rows of a run share the last observed stamp before them, so a run is a
    plain aggregation group, pre-aggregated before its shuffle.
    """
    rows = placed(
        observations.select(
            "meter_id", "timestamp", "observed_demand_kw", "is_observed", "is_interpolated"
        ),
        KEYS,
    )
    rows = with_known_around(rows, KEYS, ["observed_demand_kw"], both=False)
    return rows.groupBy(
        "meter_id", "is_observed",
        F.when(~F.col("is_observed"), F.col("observed_demand_kw_prev_at")).alias("last_observed"),
    ).agg(
        F.count(F.lit(1)).alias("n_intervals"),
        F.count_if("is_interpolated").alias("n_interpolated"),
        F.min("timestamp").alias("first_at"),
        F.max("timestamp").alias("last_at"),
    )


def gap_runs(observations: DataFrame) -> DataFrame:
    """One row per run of consecutive non-observed intervals of a meter."""
    return (
        observed_and_runs(observations)
        .where(~F.col("is_observed"))
        .select(
            "meter_id",
            F.col("n_intervals").alias("gap_intervals"),
            F.col("first_at").alias("gap_start"),
            F.col("last_at").alias("gap_end"),
        )
    )
