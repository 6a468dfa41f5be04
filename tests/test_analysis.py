"""The whole run on a small harbour: four meters at half hours over sixteen winter days, with losses and repeated rows."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from meterweave.operators import validation
from meterweave.plans import analysis
from meterweave.sources import sinks

FIRST = datetime(2024, 2, 5, 0, 30)
STAMPS = [FIRST + timedelta(minutes=30 * i) for i in range(16 * 48)]
METERS = ("mill", "pier", "vault", "yard")
#: First and last lost stamp, by meter.
LOST = {
    "yard": (datetime(2024, 2, 9, 3), datetime(2024, 2, 9, 5)),
    "pier": (datetime(2024, 2, 13, 20), datetime(2024, 2, 14, 7, 30)),
}
DOOR_OPEN = datetime(2024, 2, 16).date()


def sky(at):
    return 38 + 7 * np.cos((at.hour - 14) / 12 * np.pi) - (at.day % 5)


def demand(meter, at, rng):
    hour = at.hour + at.minute / 60
    noise = rng.uniform(-2, 2)
    if meter == "mill":  # two shifts on working days, started up at seven
        return 30 + noise + (at.weekday() < 5) * (220 * (6 <= hour < 22) + 90 * (hour == 7))
    if meter == "pier":  # cranes follow the tide, fifty minutes later every day
        tide = (hour - (at.date() - FIRST.date()).days * 5 / 6) % 12
        return 15 + noise + 130 * (tide < 2.5)
    if meter == "yard":  # lights and heating at night
        return 25 + noise + 60 * (hour < 6 or hour >= 18) + 1.5 * max(45 - sky(at), 0)
    return 110 + noise + 150 * (at.date() == DOOR_OPEN)


def raw_rows():
    rng = np.random.default_rng(7)
    rows = []
    for meter in METERS:
        low, high = LOST.get(meter, (datetime.max, datetime.min))
        rows += [(at.strftime("%d.%m.%Y %H:%M"), meter, f"{demand(meter, at, rng):.3f}") for at in STAMPS if not low <= at <= high]
    again = [r for r in rows if r[1] == "pier"][100:103]
    return [(*r, i) for i, r in enumerate(rows + again)]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    def pairs(rows, names):
        return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))

    raw = spark.createDataFrame(raw_rows(), "read string, meter string, load string, position int")
    hours = [datetime(2024, 2, 5) + timedelta(hours=i) for i in range(16 * 24 + 1)]
    weather = spark.createDataFrame([(at, float(sky(at))) for at in hours], "timestamp timestamp_ntz, temperature_f double")
    sites = analysis.Sites(
        pairs([(m,) for m in METERS], ("meter_id",)),
        pairs([("Docks", "pier"), ("Docks", "yard"), ("Works", "mill")], ("group_name", "meter_id")),
        pairs([("Harbour", "Docks"), ("Harbour", "Works")], ("parent", "child")),
        pairs([("vault",)], ("meter_id",)),
    )
    settings = analysis.Settings(
        {"timestamp": "read", "meter_id": "meter", "demand_kw": "load"}, "auto", ordinal="position",
        weather_tolerance_minutes=30, holidays=("2024-02-19",), thresholds_kw=(120.0, 260.0),
    )
    stage = analysis.written(str(tmp_path_factory.mktemp("stages")))
    observations, minutes, findings = analysis.prepare(raw, settings, weather, stage)
    return observations, minutes, findings, analysis.analyze(observations, minutes, sites, settings, stage)


@pytest.mark.parametrize("pattern", ["dd.MM.yyyy HH:mm", "missing"])
def test_the_source_is_read_once(spark, tmp_path, pattern):
    rows = raw_rows()[:200] + [("05.02.2024 00:30", "mill", "none", 900), ("no time", "mill", "1", 901), ("06.02.2024 00:30", None, "-3", 902)]
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    columns = "timestamp string, meter_id string, demand_kw string, position int"
    raw = spark.createDataFrame(rows, columns).mapInArrow(passed, columns)
    if pattern == "missing":
        with pytest.raises(validation.ValidationError, match="demand_kw"):
            analysis.prepare(raw.drop("demand_kw"), analysis.Settings())
        return
    levels = {"unparsable_timestamp": "info", "nonnumeric_demand": "warning", "negative_demand": "warning", "missing_meter_id": "warning"}
    settings = analysis.Settings(timestamp_pattern=pattern, ordinal="position", severities=levels)
    observations, minutes, findings = analysis.prepare(raw, settings, stage=analysis.written(str(tmp_path)))
    assert minutes == 30 and observations.where("meter_id = 'mill'").count() >= 200
    got = {r.message: (r.severity, r.n) for r in findings.collect()}
    assert seen.value == len(rows)
    want = validation.validate_readings(spark.createDataFrame(rows, columns), levels, pattern)
    assert got == {r.message: (r.severity, r.n) for r in want.collect()} and len(got) == 5


def test_observations(run):
    observations, minutes, findings, _ = run
    assert minutes == 30
    assert [(r.severity, r.n) for r in findings.collect()] == [("ERROR", 3)]
    pdf = observations.toPandas()
    assert len(pdf) == len(METERS) * len(STAMPS)
    # Four rows of each loss are filled: of five in the yard, of twenty-four at the pier.
    flags = pdf.groupby(["meter_id", "data_quality_flag"]).size()
    assert (flags["yard", "interpolated"], flags["yard", "missing"]) == (4, 1)
    assert (flags["pier", "interpolated"], flags["pier", "missing"]) == (4, 20)
    assert flags["mill", "observed"] == flags["vault", "observed"] == len(STAMPS)
    assert pdf[pdf.is_observed].observed_demand_kw.equals(pdf[pdf.is_observed].analysis_demand_kw)
    assert pdf[pdf.data_quality_flag != "missing"].temperature_f.notna().all()


def test_roll_up_and_days(run):
    tables = run[3]
    load = tables["entity_load"].toPandas().pivot(index="timestamp", columns="entity_id", values="demand_kw")
    np.testing.assert_allclose(load["Docks"], load[["pier", "yard"]].sum(axis=1))
    np.testing.assert_allclose(load["Portfolio"], load[["mill", "pier", "yard"]].sum(axis=1))
    np.testing.assert_allclose(load["Harbour"], load["Portfolio"])
    days = tables["daily_features"].toPandas()
    assert set(days.groupby("entity_id").size()) == {17}  # the last stamp is a midnight
    assert ((days.load_factor > 0) & (days.load_factor <= 1 + 1e-12)).all()
    pier = days[days.entity_id == "pier"].set_index(days[days.entity_id == "pier"].date.astype(str))
    assert list(pier.index[~pier.is_complete_day.astype(bool)]) == ["2024-02-05", "2024-02-13", "2024-02-14", "2024-02-21"]
    # Forty observed and four filled half hours before the loss.
    assert pier.loc["2024-02-13"].daily_energy_kwh / pier.loc["2024-02-13"].mean_demand_kw * 2 == pytest.approx(44)
    assert pier.loc["2024-02-21"].load_factor == 1.0 and np.isnan(pier.loc["2024-02-21"].standard_deviation_kw)
    covered = {str(r.date): r.is_fully_covered for r in tables["day_coverage"].where("entity_id = 'Docks'").collect()}
    assert not covered["2024-02-09"] and not covered["2024-02-14"] and covered["2024-02-10"]


def test_what_the_days_are_like(run):
    tables = run[3]
    outliers = tables["outlier_days"].where("entity_id = 'vault'").toPandas()
    assert set(outliers.date) == {DOOR_OPEN}
    timing = tables["timing_patterns"].where("entity_id = 'mill'").toPandas()
    assert dict(zip(timing.representative_peak_time, timing.frequency, strict=True))["07:00"] == 11
    sizes = tables["clusters"].where("entity_id = 'mill' and kind = 'absolute'").toPandas().cluster_size
    assert sorted(sizes) == [4, 11]
    choice = {r.entity_id: r.n_clusters for r in tables["cluster_choice"].where("kind = 'absolute'").collect()}
    assert choice["mill"] == 2
    best = tables["change_points"].where("is_selected").toPandas()
    assert set(best.meter_id) == set(METERS)
    warmth = tables["daily_temperature"].toPandas().pivot(index="date", columns="entity_id", values="mean_temperature_f")
    assert set(warmth.columns) == {*METERS, "Docks", "Works", "Harbour", "Portfolio"}
    # The yard has lost fewer temperatures than the pier.
    assert warmth["Docks"].equals(warmth["yard"]) and warmth["Portfolio"].equals(warmth["mill"])


def test_how_meters_coincide(run):
    tables = run[3]
    share = tables["peak_contribution"].toPandas().groupby(["entity_id", "timestamp"]).pct_contribution.sum()
    np.testing.assert_allclose(share, 100)
    factor = tables["diversity_factor"].toPandas().set_index("entity_id").diversity_factor
    assert (factor >= 1 - 1e-12).all() and factor["Works"] == pytest.approx(1)
    assert tables["interval_coincidence"].toPandas().coincidence_rate.dropna().between(0, 1).all()


def test_all_tables_can_be_written(run, tmp_path):
    tables = {k: v for k, v in run[3].items() if k in ("quality_summary", "peak_events", "clusters", "timing_patterns", "stage_summary", "demand_classes", "ramps")}
    for path in sinks.write_outputs(tables, str(tmp_path), "csv", per_entity=True).values():
        assert any((tmp_path / path.split("/")[-1]).rglob("*.csv"))
