from datetime import date, timedelta

from meterweave.operators import patterns

DAY = date(2025, 6, 1)


def features(spark, rows):
    """(entity, peak_minute, energy, maximum, complete) per day."""
    made = {}
    out = []
    for entity, *rest in rows:
        i = made[entity] = made.get(entity, -1) + 1
        out.append((entity, DAY + timedelta(days=i), *rest))
    return spark.createDataFrame(
        out,
        "entity_id string, date date, peak_minute int, daily_energy_kwh double, maximum_demand_kw double, is_complete_day boolean",
    )


def test_recurring_timing_numbers_all_buckets(spark):
    rows = [("A", m, 1.0, 1.0, True) for m in (30, 615, 600, 629, 1020)] + [("A", 610, 1.0, 1.0, False)]
    got = patterns.recurring_peak_timing(features(spark, rows)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.pattern_id, r.representative_peak_time, r.frequency, r.statistical_support) == ("A_peak_timing_001", "10:00", 3, 0.6)
    assert r.description == "Daily peak recurs near 10:00 on 3 of 5 complete days"
    assert r.dates == [DAY + timedelta(days=i) for i in (1, 2, 3)]


def test_recurring_shapes_count_days_without_data(spark):
    names = ["flat"] * 2 + ["multi_peak"] * 3 + ["insufficient_data"] * 3
    rows = spark.createDataFrame([("A", DAY + timedelta(days=i), n) for i, n in enumerate(names)], "entity_id string, date date, primary_shape string")
    got = patterns.recurring_shapes(rows).collect()
    assert [(r.pattern_id, r.shape, r.statistical_support) for r in got] == [("A_shape_002", "multi_peak", 0.375)]


def test_outliers_number_on_over_both_metrics(spark):
    rows = [("A", 1, 10.0 + i % 2, 5.0 + i % 2, True) for i in range(19)] + [("A", 1, 90.0, 50.0, True)]
    rows += [("B", 1, 1.0 + 99 * (i == 3), 1.0, True) for i in range(4)] + [("C", 1, 7.0, 7.0, True)] * 9
    got = sorted(patterns.outlier_days(features(spark, rows)).collect(), key=lambda r: r.pattern_id)
    assert [(r.pattern_id, r.metric, r.date) for r in got] == [
        ("A_outlier_000", "daily_energy_kwh", DAY + timedelta(days=19)),
        ("A_outlier_001", "maximum_demand_kw", DAY + timedelta(days=19)),
    ]
    assert got[0].description == f"2025-06-20 is an outlier on daily_energy_kwh (z={got[0].z_score:.2f})"
