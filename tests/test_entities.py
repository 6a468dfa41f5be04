from datetime import timedelta

import pytest

from meterweave.operators import coincidence, entities, gaps, groups, weather
from helpers import START, column, readings


def pairs(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def tree(spark):
    members = pairs(spark, [("Administration", "B001"), ("Academic", "B002"), ("Overnight", "B003")], ("group_name", "meter_id"))
    children = pairs(
        spark,
        [("Campus_A", "Administration"), ("Campus_A", "Academic"), ("AllMeters", "Campus_A"), ("AllMeters", "Overnight")],
        ("parent", "child"),
    )
    return members, children


def test_groups_resolve_to_meters(spark):
    got = {}
    for r in groups.resolve_groups(*tree(spark)).collect():
        got.setdefault(r.group_name, []).append(r.meter_id)
    assert sorted(got["Campus_A"]) == ["B001", "B002"]
    assert sorted(got["AllMeters"]) == ["B001", "B002", "B003"]
    assert got["Overnight"] == ["B003"]


def test_deep_chain_and_diamond(spark):
    chain = [(f"g{i}", f"g{i + 1}") for i in range(20)] + [("g0", "g5")]
    members = pairs(spark, [("g20", "m")], ("group_name", "meter_id"))
    got = groups.resolve_groups(members, pairs(spark, chain, ("parent", "child")))
    assert got.count() == 21


def test_cycles_are_refused_and_reported(spark):
    members = pairs(spark, [("X", "B001"), ("Y", "NOPE")], ("group_name", "meter_id"))
    children = pairs(spark, [("X", "Y"), ("Y", "X"), ("Z", "Z"), ("X", "W")], ("parent", "child"))
    with pytest.raises(Exception, match="cyclic"):
        groups.resolve_groups(members, children).collect()
    # A cycle of groups without members is one as well.
    empty = pairs(spark, [("P", "Q"), ("Q", "P")], ("parent", "child"))
    with pytest.raises(Exception, match="cyclic"):
        groups.resolve_groups(members, empty).collect()
    meters = pairs(spark, [("B001",), ("B001",), (None,)], ("meter_id",))
    names = pairs(spark, [("X",), ("Y",), ("Z",), (None,)], ("name",))
    got = sorted(r.message for r in groups.group_tree_check(meters, names, members, children).collect())
    assert got == [
        "A group entry is missing name", "A meter entry is missing meter_id",
        "Cyclic group hierarchy involving 'X'", "Cyclic group hierarchy involving 'Y'", "Duplicate meter_id: B001",
        "Group 'X' references unknown child group 'W'", "Group 'Y' references unknown meter_id 'NOPE'",
        "Group 'Z' lists itself as a child group",
    ]


def test_groups_are_walked_when_they_are_read(spark):
    """Building the plans starts no job."""
    members, children = tree(spark)
    spark.sparkContext.setJobGroup("building", "")
    groups.resolve_groups(members, children)
    groups.group_tree_check(pairs(spark, [("B001",)], ("meter_id",)), pairs(spark, [("Campus_A",)], ("name",)), members, children)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def observed(spark, **meters):
    frames = [gaps.fill_gaps(readings(spark, values, name), 60) for name, values in meters.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def joint(spark, *names, entity="All"):
    return spark.createDataFrame([(entity, "group", n) for n in names], "entity_id string, entity_type string, meter_id string")


def test_load_is_a_sum_over_reporting_meters(spark):
    obs = observed(spark, a=[500.0, 500.0], b=[300.0], c=[200.0])
    single = spark.createDataFrame([("a", "meter", "a")], "entity_id string, entity_type string, meter_id string")
    load = entities.entity_load(obs, joint(spark, "a", "b", "c").unionByName(single))
    group = load.where("entity_id = 'All'")
    assert column(group, "demand_kw") == [1000.0, 500.0]
    assert column(group, "n_meters_reporting") == [3, 1]
    assert column(load.where("entity_id = 'a'"), "n_meters_reporting") == [1, 1]


def test_load_is_missing_where_nobody_reports(spark):
    obs = observed(spark, a=[1.0] + [None] * 9 + [2.0])
    load = entities.entity_load(obs, joint(spark, "a"))
    assert column(load, "demand_kw")[6] is None and column(load, "n_meters_reporting")[6] == 0


def test_contribution_diversity_coincidence(spark):
    obs = observed(spark, a=[10.0, 1.0, 9.5, 2.0], b=[1.0, 10.0, 9.2, 2.0], c=[0.0, 0.0, 0.0, 5.0])
    members = joint(spark, "a", "b", "c", "absent")
    top = coincidence.peak_contribution(obs, members, 1).collect()
    assert {r.meter_id: round(r.pct_contribution, 3) for r in top} == {"a": 50.802, "b": 49.198, "c": 0.0}
    factor = coincidence.diversity_factor(obs, members).first()
    assert (factor.sum_of_individual_peaks_kw, factor.aggregate_peak_kw) == (25.0, 18.7)
    got = {r.meter_id: tuple(r)[2:] for r in coincidence.interval_coincidence(obs, members).collect()}
    assert got == {"a": (2, 1, 0.5), "b": (2, 1, 0.5), "c": (1, 0, 0.0), "absent": (0, 0, None)}


def stamps(spark, *minutes, values=None):
    rows = [("M", START + timedelta(minutes=m), v) for m, v in zip(minutes, values or [None] * len(minutes))]
    return spark.createDataFrame(rows, "meter_id string, timestamp timestamp_ntz, temperature_f double")


def sky(spark, *rows):
    return spark.createDataFrame([(START + timedelta(minutes=m), v) for m, v in rows], "timestamp timestamp_ntz, temperature_f double")


def test_nearest_weather(spark):
    rows = stamps(spark, 30, 31, 120, 121).drop("temperature_f")
    got = column(weather.asof_temperature(rows, sky(spark, (0, 2.0), (60, 3.0)), 60), "external_temperature_f")
    assert got == [2.0, 3.0, 3.0, None]
    unlimited = weather.asof_temperature(stamps(spark, -5000, 31, 9000).drop("temperature_f"), sky(spark, (0, 2.0), (60, 3.0)))
    assert column(unlimited, "external_temperature_f") == [2.0, 3.0, 3.0]


def test_nearest_weather_against_all_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    at = sorted({int(m) for m in rng.integers(0, 6000, 150)})
    sky_rows = [(m, float(i)) for i, m in enumerate(at)]
    asked = [int(m) for m in rng.integers(-500, 6500, 400)]
    got = weather.nearest_weather(stamps(spark, *asked), sky(spark, *sky_rows), 25).collect()
    have = {(r.timestamp - START) // timedelta(minutes=1): r.external_temperature_f for r in got}
    want = {}
    for m in asked:
        distance, _, value = min((abs(m - w), w, v) for w, v in sky_rows)
        if distance <= 25:
            want[m] = value
    assert have == want


@pytest.mark.parametrize("override, expected", [(False, [999.0, 32.0]), (True, [30.0, 32.0])])
def test_merge_temperature(spark, override, expected):
    rows = stamps(spark, 0, 60, values=[999.0, None])
    merged = weather.merge_temperature(rows, sky(spark, (0, 30.0), (60, 32.0)), 30, override)
    assert column(merged, "temperature_f") == expected
    bare = weather.merge_temperature(rows.drop("temperature_f"), sky(spark, (0, 30.0)), 30)
    assert column(bare, "temperature_f") == [30.0, None]
    assert weather.merge_temperature(rows, None) is rows
