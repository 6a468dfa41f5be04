from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterweave.functions.quantiles import exact_percentiles
from meterweave.operators import demand, events, features, profiles, shapes
from meterweave.plans.days import with_date
from helpers import START, column, series


def load(spark, values, **options):
    return with_date(series(spark, values, **options))


def test_threshold_classes(spark):
    rows = demand.class_threshold(load(spark, [31.0, None, 75.0, 74.9, 120.0]), [75.0])
    assert column(rows, "meets_threshold_75") == [False, False, True, False, True]
    with pytest.raises(ValueError, match="collide"):
        demand.class_threshold(rows, [500.0, 500.5])


def test_percentile_classes(spark):
    rows = demand.class_percentile(load(spark, [float(v * 7 % 41) for v in range(41)] + [None]), [0.9])
    assert sum(column(rows, "top_pct_90")) == 5


def test_percentiles_of_few_rows_beside_the_accuracy_of_the_sketch(spark):
    values = {n: [float(v * 13 % 127) for v in range(n)] for n in (1, 2, 3, 7, 59, 60, 61, 120)}
    rows = spark.createDataFrame([(k, x) for k, v in values.items() for x in v], "k int, v double").withColumn("date", F.current_date())
    ps = [0.0, 0.25, 0.8, 0.99, 1.0]
    for r in exact_percentiles(rows, "k", "v", ps, 60).collect():
        assert r.cutoffs == pytest.approx(list(np.quantile(values[r.k], ps)), rel=1e-12)


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_percentiles_are_exact_also_through_the_bracket(spark, accuracy):
    rng = np.random.default_rng(1)
    values = {"even": rng.uniform(0, 1, 3000), "ties": rng.integers(0, 5, 3000) * 1.0, "tail": rng.pareto(1, 3000), "few": np.array([4.0, 1.0])}
    rows = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v], "k string, v double")
    rows = rows.withColumn("date", F.date_add(F.lit("2025-01-01").cast("date"), (F.rand(1) * 9).cast("int")))
    ps = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0]
    for r in exact_percentiles(rows, "k", "v", ps, accuracy).collect():
        assert r.cutoffs == pytest.approx(list(np.quantile(values[r.k], ps)), rel=1e-12)


def test_rank_classes(spark):
    rows = demand.class_rank(load(spark, [5.0, 9.0, 9.0, None, 3.0]), [1, 2, 3])
    assert column(rows, "top_rank_1") == [False, True, False, False, False]
    assert column(rows, "top_rank_2") == [False, True, True, False, False]
    assert column(rows, "top_rank_3") == [True, True, True, False, False]


def test_ramps(spark):
    rows = demand.ramps(load(spark, [7.0, 7.0, 2.5, 11.0, None, 4.0]))
    assert column(rows, "ramp_kw") == [None, 0.0, -4.5, 8.5, None, None]
    assert column(rows, "ramp_up_kw") == [None, 0.0, 0.0, 8.5, None, None]
    assert column(rows, "ramp_down_kw") == [None, 0.0, 4.5, 0.0, None, None]


def test_extrema(spark):
    rows = demand.local_extrema(load(spark, [8.0, 5.0, 9.0, 9.0, 4.0, 6.0, 3.0]))
    assert column(rows, "is_peak") == [False, False, False, False, False, True, False]
    assert column(rows, "is_valley") == [False, True, False, False, True, False, False]


def test_extrema_and_ramps_run_across_midnight(spark):
    rng = np.random.default_rng(2)
    kw = [None if rng.random() < 0.05 else float(v) for v in rng.integers(0, 9, 200)]
    rows = load(spark, kw)
    peaks = column(demand.local_extrema(rows), "is_peak")
    steps = column(demand.ramps(rows), "ramp_kw")
    for i in range(200):
        around = kw[max(i - 1, 0) : i + 2]
        known = 0 < i < 199 and None not in around
        assert peaks[i] == (known and kw[i] > kw[i - 1] and kw[i] > kw[i + 1])
        assert steps[i] == (None if i == 0 or None in kw[i - 1 : i + 1] else kw[i] - kw[i - 1])


def found(spark, values, gap=1, **options):
    rows = events.peak_events(load(spark, values, **options), demand.meets(500.0), gap, "t")
    return rows.orderBy("event_id").collect()


def test_events(spark):
    got = found(spark, [520.0, 510, 505, 20, 30, 40, 900, 10, 501, 0, 0], minutes=30)
    assert [(r.event_id, r.n_intervals, r.duration_hours, r.minimum_demand_kw) for r in got] == [
        ("X_t_0000", 3, 1.0, 505.0), ("X_t_0001", 3, 1.0, 10.0),
    ]
    apart = found(spark, [520.0, 510, 505, 20, 30, 40, 900, 10, 501, 0, 0], gap=0)
    assert [(r.n_intervals, r.duration_hours) for r in apart] == [(3, 2.0), (1, 0.0), (1, 0.0)]
    assert found(spark, [499.9, None, 12.0]) == []


@pytest.mark.parametrize("gap, share", [(0, 0.5), (1, 0.3), (3, 0.1), (30, 0.04), (2, 1.0)])
def test_events_against_a_walk_over_days(spark, gap, share):
    rng = np.random.default_rng(gap)
    kw = [None if rng.random() < 0.1 else 600.0 if rng.random() < share else float(rng.integers(0, 400)) for _ in range(300)]
    want = []
    last = None
    for i, v in enumerate(kw):
        if v is not None and v >= 500:
            if last is not None and i - last - 1 <= gap:
                want[-1][1] = i
            else:
                want.append([i, i])
            last = i
    got = found(spark, kw, gap)
    assert [(r.start_time, r.n_intervals) for r in got] == [
        (START + timedelta(hours=i), j - i + 1) for i, j in want
    ]
    for r, (i, j) in zip(got, want):
        inside = [v for v in kw[i : j + 1] if v is not None]
        assert r.mean_demand_kw == pytest.approx(np.mean(inside)) and r.minimum_demand_kw == min(inside)


def test_duration_class(spark):
    rows = spark.createDataFrame([(0.0,), (2.75,), (3.0,), (40.0,)], "duration_hours double")
    assert [r.duration_class for r in events.event_duration_class(rows, 3.0).collect()] == ["short", "short", "sustained", "sustained"]


def test_profiles_and_features(spark):
    values = [float(v) for v in (list(range(1, 24)) + [23])] + [2.0, None] + [None] * 24
    daily = profiles.daily_profiles(load(spark, values), 60)
    days = {r.date.day: r for r in profiles.daily_features(daily, 60).collect()}
    assert [days[d].is_complete_day for d in (1, 2, 3)] == [True, False, False]
    assert days[1].peak_time == "22:00:00"  # the first of two equal maxima
    assert days[1].load_factor == pytest.approx(days[1].mean_demand_kw / 23)
    assert days[1].standard_deviation_kw == pytest.approx(np.std(values[:24], ddof=1))
    assert (days[3].daily_energy_kwh, days[3].mean_demand_kw, days[3].peak_time) == (0.0, None, None)
    top = profiles.normalized_profiles(daily).groupBy("date").agg(F.max("normalized_demand").alias("m")).collect()
    assert {r.date.day: r.m for r in top} == {1: 1.0, 2: 1.0, 3: None}
    zero = profiles.daily_features(profiles.daily_profiles(load(spark, [0.0, 0.0]), 60), 60).first()
    assert (zero.load_factor, zero.coefficient_of_variation) == (None, None)


def test_segments_and_bands(spark):
    daily = profiles.daily_profiles(load(spark, [float(h) for h in range(24)]), 60)
    seg = features.segment_features(daily).first()
    assert (seg.morning_peak_kw, seg.midday_peak_kw, seg.afternoon_peak_kw, seg.evening_peak_kw) == (9, 13, 17, 21)
    assert seg.overnight_mean_kw == seg.nighttime_mean_kw == pytest.approx((sum(range(6)) + 22 + 23) / 8)
    temps = spark.createDataFrame([(-4.0,), (71.5,), (70.0,), (None,), (40.0,), (88.0,)], "temperature_f double")
    bands = [r.temperature_band for r in features.temperature_bands(temps, [40, 55, 70]).collect()]
    assert bands == ["below-40", "70-above", "55-70", None, "below-40", "70-above"]


def test_daily_temperature_and_weekday_means(spark):
    rows = series(spark, [10.0, 20.0, None], key="meter_id", column="temperature_f").withColumn("analysis_demand_kw", F.lit(1.0))
    day = features.daily_temperature(rows).first()
    assert (day.mean_temperature_f, day.temperature_range_f) == (15.0, 10.0)
    assert features.daily_temperature(rows.withColumn("temperature_f", F.lit(None).cast("double"))).count() == 0
    week = series(spark, [1.0] * 24 * 7, key="meter_id", column="analysis_demand_kw").withColumn("temperature_f", F.lit(5.0))
    assert features.weekday_daily_means(week).count() == 5


def shaped(spark, values, extrema=True):
    daily = profiles.daily_profiles(load(spark, values), 60)
    found = profiles.daily_features(daily, 60)
    return shapes.day_shapes(demand.local_extrema(daily) if extrema else daily, found).first()


def test_shapes(spark):
    gone = shaped(spark, [None, 8.0, None, None])
    assert gone.primary_shape == "insufficient_data" and gone.is_unusual
    flat = shaped(spark, [10.0] * 24)
    assert flat.primary_shape == "flat" and flat.is_flat and flat.has_sustained_high_load
    for hour, name in ((8, "morning_peak"), (11, "midday_peak"), (15, "afternoon_peak"), (20, "evening_peak")):
        assert shaped(spark, [1.0] * hour + [9.0] + [1.0] * (23 - hour)).primary_shape == name
    night = shaped(spark, [9.0] * 6 + [7.0] * 16 + [9.0] * 2)
    assert night.primary_shape == "overnight_heavy"
    twice = shaped(spark, [1.0, 2.0] * 12)
    assert twice.primary_shape == "multi_peak" and twice.has_peak_valley_pattern
    assert not shaped(spark, [1.0, 2.0] * 12, extrema=False).has_peak_valley_pattern
