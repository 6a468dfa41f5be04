import numpy as np
import pytest

from meterweave.operators import changepoint


def points(spark, **meters):
    rows = [(m, float(a), float(b)) for m, (t, d) in meters.items() for a, b in zip(t, d)]
    return spark.createDataFrame(rows, "meter_id string, temperature_f double, demand_kw double")


def hinges(t, base, heat=(0, 0), cool=(0, 0), rng=None):
    return base + heat[1] * np.maximum(heat[0] - t, 0) + cool[1] * np.maximum(t - cool[0], 0) + rng.normal(0, 0.5, len(t))


@pytest.fixture(scope="module")
def known(spark):
    """Parameter recovery: seeded points of known models."""
    made = {}
    rng = np.random.default_rng(811)
    t = rng.normal(58, 17, 260).clip(12, 97)
    made["5p"] = (t, hinges(t, 72, (49, 2.5), (69, 5.5), rng))
    rng = np.random.default_rng(823)
    t = rng.uniform(31, 88, 64)
    made["2p"] = (t, 18 + 3.2 * t + rng.normal(0, 0.5, 64))
    rng = np.random.default_rng(827)
    t = rng.uniform(-5, 71, 130)
    made["3p"] = (t, hinges(t, 41, (47, 4.5), rng=rng))
    rng = np.random.default_rng(829)
    t = rng.uniform(26, 94, 180)
    made["4p"] = (t, hinges(t, 64, (61, 1.5), (61, 4.2), rng))
    rng = np.random.default_rng(839)
    t = rng.uniform(-22, 17, 45)
    made["noise"] = (t, rng.normal(33, 8, 45))
    made["few"] = ([41, 58, 66], [9, 4, 5])
    made["broken"] = ([70.0, np.nan, np.inf, 71.0], [1.0, 2.0, 3.0, np.nan])
    made["narrow"] = (70 + np.linspace(0.1, 0.9, 12), np.arange(12.0))
    return made


def fitted(spark, known, fit):
    return {r.meter_id: r for r in fit(points(spark, **known)).collect()}


def test_recovery(spark, known):
    line = fitted(spark, known, changepoint.fit_2p)["2p"]
    assert line.slope_kw_per_f == pytest.approx(3.2, rel=0.02)
    heat = fitted(spark, known, changepoint.fit_3p_heating)["3p"]
    assert (heat.breakpoint_f, heat.slope_kw_per_f) == (pytest.approx(47, abs=1), pytest.approx(4.5, rel=0.04))
    four = fitted(spark, known, changepoint.fit_4p)["4p"]
    assert four.breakpoint_f == pytest.approx(61, abs=1)
    assert (four.heating_slope_kw_per_f, four.cooling_slope_kw_per_f) == pytest.approx((1.5, 4.2), rel=0.06)
    five = fitted(spark, known, changepoint.fit_5p)["5p"]
    assert (five.heating_breakpoint_f, five.cooling_breakpoint_f) == pytest.approx((49, 69), abs=1)
    assert (five.heating_slope_kw_per_f, five.cooling_slope_kw_per_f) == pytest.approx((2.5, 5.5), rel=0.06)


@pytest.mark.parametrize("model", list(changepoint.MIN_POINTS))
def test_too_few_points_and_narrow_range(spark, known, model):
    fit = getattr(changepoint, f"fit_{model}")
    got = fitted(spark, known, fit)
    assert set(got) == set(known)
    assert not got["few"].success and not got["broken"].success and got["broken"].n_points == 1
    assert got["few"].r_squared is None
    assert got["narrow"].success == (model == "2p")


def errors(t, d, columns):
    x = np.column_stack([np.ones_like(d), *columns])
    w, *_ = np.linalg.lstsq(x, d, rcond=None)
    return ((d - x @ w) ** 2).sum(), w[1:]


def bounded(t, d, p, q):
    """Least error with non-negative slopes, by trying every set of active hinges."""
    h, c = np.maximum(p - t, 0), np.maximum(t - q, 0)
    tries = [errors(t, d, columns) for columns in ([h, c], [h], [c], [])]
    return min(error for error, slopes in tries if (slopes >= 0).all())


def test_errors_equal_direct_least_squares(spark, known):
    got = {(r.meter_id, r.model): r for r in changepoint.select_model(points(spark, **known)).collect()}
    for m in ("5p", "3p", "4p", "noise"):
        t, d = (np.asarray(v, float) for v in known[m])
        sst = ((d - d.mean()) ** 2).sum()
        grid = np.arange(np.floor(t.min()) + 1, np.ceil(t.max()))
        want = {
            "2p": errors(t, d, [t])[0],
            "3p_heating": min(errors(t, d, [np.maximum(p - t, 0)])[0] for p in grid),
            "3p_cooling": min(errors(t, d, [np.maximum(t - p, 0)])[0] for p in grid),
            "4p": min(bounded(t, d, p, p) for p in grid),
            "5p": min(bounded(t, d, p, q) for p in grid for q in grid if p <= q),
        }
        for model, error in want.items():
            assert got[m, model].r_squared == pytest.approx(1 - error / sst, abs=1e-9), (m, model)


def test_selection(spark, known):
    rng = np.random.default_rng(853)
    t = rng.uniform(5, 96, 280)
    five = (t, hinges(t, 38, (41, 3.4), (74, 6.1), rng))
    rng = np.random.default_rng(857)
    t = rng.uniform(34, 91, 150)
    line = (t, 27 + 2.3 * t + rng.normal(0, 0.5, 150))
    rows = changepoint.select_model(points(spark, five=five, line=line, few=known["few"])).collect()
    assert {r.meter_id: r.model for r in rows if r.is_selected} == {"five": "5p", "line": "2p"}
    assert sum(r.meter_id == "few" for r in rows) == 5
