from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterweave.operators import gaps, quality
from helpers import START, column, readings


def filled(spark, values, **options):
    frame = gaps.fill_gaps(readings(spark, values), 60, **options)
    return column(frame, "analysis_demand_kw")


def absent(*values):
    return [None if v == "-" else float(v) for v in values]


# A present row with NULL demand stretches the grid by one at the end.
def long_gap(spark):
    rows = readings(spark, absent(1, "-", "-", "-", "-", "-", "-", 8))
    tail = spark.createDataFrame([("M", START + timedelta(hours=8), None)], rows.schema)
    return rows.unionByName(tail)


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, (1, 2, 3, 4, 5, "-", "-", 8, "-")),
        ({"forward": True}, (1, 2, 3, 4, 5, 5, 5, 8, 8)),
        ({"backward": True}, (1, 2, 3, 4, 5, 8, 8, 8, "-")),
        ({"limit": 0}, (1, "-", "-", "-", "-", "-", "-", 8, "-")),
        ({"enabled": False, "forward": True}, (1, "-", "-", "-", "-", "-", "-", 8, "-")),
    ],
)
def test_first_rows_of_a_long_gap_are_filled(spark, options, expected):
    got = column(gaps.fill_gaps(long_gap(spark), 60, **options), "analysis_demand_kw")
    assert got == pytest.approx(absent(*expected))


@pytest.mark.parametrize("forward, backward", [(False, False), (True, False), (False, True), (True, True)])
def test_agrees_with_a_series_in_memory_across_days(spark, forward, backward):
    """Gaps that cross one or several midnights, missing ends, several meters."""
    rng = np.random.default_rng(7)
    frames, expected = [], {}
    for m in range(6):
        n = int(rng.integers(60, 130))
        kw = pd.Series(rng.uniform(0, 100, n).round(2))
        present = rng.random(n) < (0.6, 0.3, 0.05)[m % 3]
        present[[0, -1]] = True
        kw[~present] = np.nan
        if m % 2:
            kw.iloc[[0, 1, -1]] = np.nan  # present rows without a value
        stamps = [START + timedelta(hours=int(5 + i)) for i in range(n)]
        keep = present | np.isin(np.arange(n), [0, n - 1])
        frames.append(pd.DataFrame({"meter_id": f"m{m}", "timestamp": stamps, "demand_kw": kw})[keep])
        want = kw.interpolate(limit=3, limit_area="inside")
        want = want.ffill(limit=3) if forward else want
        expected[f"m{m}"] = want.bfill(limit=3) if backward else want
    pdf = pd.concat(frames)
    rows = spark.createDataFrame(
        [(a, b.to_pydatetime(), None if np.isnan(c) else c) for a, b, c in pdf.itertuples(index=False)],
        "meter_id string, timestamp timestamp_ntz, demand_kw double",
    )
    got = gaps.fill_gaps(rows, 60, limit=3, forward=forward, backward=backward).toPandas().sort_values("timestamp")
    for m, want in expected.items():
        have = got[got.meter_id == m].analysis_demand_kw.astype(float).to_numpy()
        np.testing.assert_allclose(have, want.to_numpy(), rtol=1e-12)


def test_grid_and_flags(spark):
    frame = gaps.fill_gaps(readings(spark, absent(1, "-", 3)), 60).orderBy("timestamp").collect()
    assert [r.data_quality_flag for r in frame] == ["observed", "interpolated", "observed"]
    assert [r.observed_demand_kw for r in frame] == [1.0, None, 3.0]
    assert [r.interpolated_demand_kw for r in frame] == [None, 2.0, None]


def test_off_grid_readings_are_dropped_and_countable(spark):
    rows = readings(spark, absent(1, 2, 3)).unionByName(
        spark.createDataFrame([("M", START + timedelta(minutes=90), 9.0)], "meter_id string, timestamp timestamp_ntz, demand_kw double")
    )
    assert gaps.off_grid_readings(rows, 60).count() == 1
    assert column(gaps.fill_gaps(rows, 60), "analysis_demand_kw") == [1.0, 2.0, 3.0]


def test_quarter_hour_grid_of_a_meter_that_starts_off_the_hour(spark):
    rows = readings(spark, absent(*range(200)), minutes=15, start=START + timedelta(minutes=7, seconds=30))
    grid = gaps.regular_grid(rows, 15)
    assert column(grid, "timestamp") == column(rows, "timestamp")


def test_temperature_is_filled_on_its_own_and_extra_columns_stay(spark):
    rows = (
        readings(spark, absent(1, 2, "-", 4, 5))
        .withColumn("temperature_f", F.when(F.col("demand_kw") != 2, F.col("demand_kw") * 10))
        .withColumn("note", F.lit("n"))
    )
    frame = gaps.fill_gaps(rows, 60)
    assert column(frame, "temperature_f") == pytest.approx([10, 20, 30, 40, 50])
    assert column(frame, "note") == ["n", "n", None, "n", "n"]


def test_quality_summary_and_runs(spark):
    a = gaps.fill_gaps(readings(spark, absent(1, "-", "-", 4, "-", 6, "-", "-", 9), "A"), 60, limit=1)
    b = gaps.fill_gaps(readings(spark, absent(1, 2), "B"), 60)
    both = a.unionByName(b)
    summary = {r.meter_id: r for r in quality.quality_summary(both).collect()}
    assert (summary["A"].n_gap_events, summary["A"].max_gap_intervals) == (3, 2)
    assert summary["A"].max_gap_start == START + timedelta(hours=1)
    assert (summary["A"].n_interpolated, summary["A"].n_missing) == (3, 2)
    assert (summary["B"].n_gap_events, summary["B"].max_gap_intervals, summary["B"].max_gap_start) == (0, 0, None)
    total = summary["PORTFOLIO"]
    assert (total.n_intervals, total.n_observed, total.n_gap_events, total.max_gap_intervals) == (11, 6, 3, 2)
    assert gaps.gap_runs(both).count() == 3
    assert quality.quality_detail(both).count() == 5
    assert {r[0]: r[1] for r in quality.quality_flag_counts(both).collect()} == {
        "observed": 6, "interpolated": 3, "missing": 2,
    }


def test_a_run_over_several_days_is_one_run(spark):
    frame = gaps.fill_gaps(readings(spark, absent(1, *["-"] * 70, 2)), 60)
    run = gaps.gap_runs(frame).collect()
    assert [(r.gap_intervals, r.gap_start) for r in run] == [(70, START + timedelta(hours=1))]
