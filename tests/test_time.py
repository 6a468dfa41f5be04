from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterweave.functions import clock
from meterweave.operators import calendar, resolution
from helpers import START, readings


@pytest.mark.parametrize("minutes, kwh", [(15, 25.0), (30, 50.0), (60, 100.0)])
def test_interval_energy(spark, minutes, kwh):
    rows = spark.createDataFrame([(100.0,), (None,)], "analysis_demand_kw double")
    got = [r.energy_kwh for r in calendar.interval_energy(rows, minutes).collect()]
    assert got == [kwh, None]


@pytest.mark.parametrize("minutes, n", [(15, 96), (30, 48), (60, 24)])
def test_intervals_per_day(minutes, n):
    assert clock.intervals_per_day(minutes) == n


def test_calendar(spark):
    days = [datetime(2025, 6, 2), datetime(2025, 6, 7), datetime(2025, 6, 19)]
    rows = spark.createDataFrame([(d,) for d in days], "timestamp timestamp_ntz")
    got = calendar.calendar_features(rows, ["2025-06-19"]).orderBy("timestamp").collect()
    assert [r.day_type for r in got] == ["weekday", "weekend", "holiday"]
    assert [r.is_weekday for r in got] == [True, False, True]
    assert [(r.day_of_week, r.day_name, r.season) for r in got][0] == (0, "Monday", "summer")


def test_micros_do_not_depend_on_the_session_time_zone(spark):
    rows = spark.createDataFrame([(datetime(2025, 3, 30, 2, 30, 0, 250),)], "timestamp timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = rows.select(
            clock.micros(F.col("timestamp")),
            clock.plus_micros(F.col("timestamp"), F.lit(clock.MINUTE).cast("long")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got[0] == (datetime(2025, 3, 30, 2, 30) - datetime(1970, 1, 1)) // timedelta(microseconds=1) + 250
    assert got[1] == datetime(2025, 3, 30, 2, 31, 0, 250)


def test_resolution(spark):
    quarter = readings(spark, [1.0] * 60 + [None] * 3 + [1.0] * 100, "A", 15, START + timedelta(hours=20))
    doubled = quarter.unionByName(quarter.limit(1))
    hourly = readings(spark, [1.0] * 30, "B", 60)
    single = readings(spark, [1.0], "C", 60)
    per_meter = resolution.detect_resolution(doubled.unionByName(hourly).unionByName(single))
    got = {r.meter_id: tuple(r)[1:] for r in per_meter.collect()}
    assert got == {"A": (15, 1, 1), "B": (60, 0, 0), "C": (None, 0, 0)}
    overall = resolution.overall_resolution(per_meter).first()
    assert tuple(overall) == (15, True, 1, 1)  # a tie of the meters: the smaller interval
    assert resolution.interval_minutes(hourly) == 60
    assert resolution.interval_minutes(hourly, "30min") == 30
    with pytest.raises(ValueError):
        resolution.interval_minutes(single)
