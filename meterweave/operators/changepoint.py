"""Temperature change-point regressions by grouped moments.

Input: points(meter_id, temperature_f, demand_kw), one row per meter and day. A
hinge max(p - T, 0) or max(T - p, 0) at a whole degree p splits the points at a
bin border of floor(T), so one pre-aggregated row per (meter, degree) holds all
that any breakpoint needs. Running sums along the degrees give, for every p,
count, sum and sum of squares of the hinge and its product with demand; least
squares for one or two hinges then is arithmetic on one row. The sums grow
degree by degree from non-negative parts, so nothing cancels.

Among breakpoints the lowest squared error wins; errors that agree to 1e-9 of
the total are equal, and the lower breakpoints win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Least number of points, number of parameters, order on ties.
MIN_POINTS = {"2p": 4, "3p_heating": 5, "3p_cooling": 5, "4p": 8, "5p": 10}
PARAMETERS = {"2p": 2, "3p_heating": 3, "3p_cooling": 3, "4p": 4, "5p": 5}
METHODS = {
    "2p": "change_point_regression_2p",
    "3p_heating": "change_point_regression_3p_heating",
    "3p_cooling": "change_point_regression",
    "4p": "change_point_regression_4p",
    "5p": "change_point_regression_5p",
}
PARAMETER_COLUMNS = (
    "base_kw", "slope_kw_per_f", "heating_slope_kw_per_f", "cooling_slope_kw_per_f",
    "breakpoint_f", "heating_breakpoint_f", "cooling_breakpoint_f",
)
EQUAL_DIGITS = 9


def _finite(c: str) -> Column:
    return F.when(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))


def _paired(points: DataFrame) -> DataFrame:
    """Keep all meters; blank out pairs with a non-finite member."""
    t, d = _finite("temperature_f"), _finite("demand_kw")
    both = t.isNotNull() & d.isNotNull()
    return points.select("meter_id", F.when(both, t).alias("t"), F.when(both, d).alias("d"))


TOTALS = ("n", "mean_t", "mean_d", "sxx", "sxy", "sst", "lowest", "highest")
MOMENTS = ("m", "r", "a1", "a2", "ar", "b1", "b2", "br")


def _totals() -> dict[str, Column]:
    return {
        "n": F.count("t"),
        "mean_t": F.avg("t"),
        "mean_d": F.avg("d"),
        "sxx": F.regr_sxx("d", "t"),
        "sxy": F.regr_sxy("d", "t"),
        "sst": F.regr_syy("d", "t"),
        "lowest": F.min(F.floor("t")),
        "highest": F.max(F.ceil("t")),
    }


def _binned(points: DataFrame) -> DataFrame:
    """One row per meter: totals and the moments of each whole degree as a map.

    The points of a meter are its days and the map holds its degrees. All steps
    up to the finished fits are grouped by meter, so the points move once.
    """
    meter = Window.partitionBy("meter_id")
    rows = _paired(points).withColumns({name: c.over(meter) for name, c in _totals().items()})
    rows = (
        rows.withColumn("degree", F.floor("t"))
        .withColumn("residual", F.col("d") - F.col("mean_d"))
        .withColumn("above", F.col("t") - F.col("degree"))
        .withColumn("below", 1 - F.col("above"))
    )
    above, below, residual = F.col("above"), F.col("below"), F.col("residual")
    bins = rows.groupBy("meter_id", *TOTALS, "degree").agg(
        F.count(F.lit(1)).cast("double").alias("m"),
        F.sum(residual).alias("r"),
        F.sum(above).alias("a1"), F.sum(above * above).alias("a2"), F.sum(above * residual).alias("ar"),
        F.sum(below).alias("b1"), F.sum(below * below).alias("b2"), F.sum(below * residual).alias("br"),
    )
    entry = F.when(F.col("degree").isNotNull(), F.struct("degree", F.struct(*MOMENTS).alias("moments")))
    return bins.groupBy("meter_id", *TOTALS).agg(F.map_from_entries(F.collect_list(entry)).alias("bins"))


def _hinges(points: DataFrame) -> DataFrame:
    """Per (meter, whole degree p): totals and the centred moments of both hinges.

    Breakpoints lie strictly inside the temperature range; other rows have p
    NULL, and a meter without points keeps one such row.
    """
    moments = F.try_element_at("bins", F.col("degree"))
    filled = _binned(points).withColumn("degree", F.explode_outer(F.sequence("lowest", "highest"))).select(
        "meter_id", *TOTALS, "degree", *[F.coalesce(moments[c], F.lit(0.0)).alias(c) for c in MOMENTS]
    )
    along = Window.partitionBy("meter_id").orderBy("degree")
    back = Window.partitionBy("meter_id").orderBy(F.desc("degree"))
    lower = along.rowsBetween(Window.unboundedPreceding, -1)
    higher = back.rowsBetween(Window.unboundedPreceding, -1)
    upto = back.rowsBetween(Window.unboundedPreceding, 0)

    def total(c: Column, frame) -> Column:
        return F.coalesce(F.sum(c).over(frame), F.lit(0.0))

    # One degree further on every excess grows by one: H2(p+1) = H2(p) + 2 H1(p) + N(p) + b2(p).
    rows = filled.withColumns({"hn": total(F.col("m"), lower), "hr": total(F.col("r"), lower)})
    rows = rows.withColumn("h1", total(F.col("hn") + F.col("b1"), lower))
    rows = rows.withColumns(
        {
            "h2": total(F.col("hn") + 2 * F.col("h1") + F.col("b2"), lower),
            "hd": total(F.col("hr") + F.col("br"), lower),
        }
    )
    rows = rows.withColumns({"cn": total(F.col("m"), higher), "cr": total(F.col("r"), higher)})
    rows = rows.withColumn("c1", total(F.col("cn") + F.col("a1"), upto))
    further = F.col("c1") - F.col("cn") - F.col("a1")
    rows = rows.withColumns(
        {
            "c2": total(F.col("cn") + 2 * further + F.col("a2"), upto),
            "cd": total(F.col("cr") + F.col("ar"), upto),
        }
    )
    inside = (F.col("degree") > F.col("lowest")) & (F.col("degree") < F.col("highest"))
    return rows.select(
        "meter_id", *TOTALS,
        F.when(inside, F.col("degree").cast("double")).alias("hp"),
        F.when(inside, F.col("degree").cast("double")).alias("cp"),
        "h1", (F.col("h2") - F.col("h1") * F.col("h1") / F.col("n")).alias("hh"), "hd",
        "c1", (F.col("c2") - F.col("c1") * F.col("c1") / F.col("n")).alias("cc"), "cd",
    )


def _pairs(hinges: DataFrame) -> DataFrame:
    """Each heating breakpoint with every cooling breakpoint at or above it.

    The search over pairs of whole degrees is the definition of the model; its
    size is set by the temperature range, not by the number of readings.
    """
    from_here_up = Window.partitionBy("meter_id").orderBy(F.desc("hp")).rowsBetween(Window.unboundedPreceding, 0)
    cooling = ("cp", "c1", "cc", "cd")
    upper = F.collect_list(F.when(F.col("cp").isNotNull(), F.struct(*cooling))).over(from_here_up)
    kept = [c for c in hinges.columns if c not in cooling]
    return hinges.withColumn("upper", upper).select(*kept, F.explode_outer("upper").alias("upper")).select(
        *kept, "upper.*"
    )


def _error(gain: Column) -> Column:
    """Squared error over total, rounded to where errors count as equal."""
    share = F.when(F.col("sst") > 0, 1 - gain / F.col("sst")).otherwise(0.0)
    return F.round(share, EQUAL_DIGITS)


def _order(model: str, error: Column) -> Column:
    """What the best fit minimises; NULL where the model cannot be fitted.

    All models but 5p have one breakpoint: the diagonal of the pairs.
    """
    allowed = (F.col("n") >= MIN_POINTS[model]) & F.col("hp").isNotNull() & F.col("cp").isNotNull()
    if model == "5p":
        allowed = allowed & (F.col("highest") - F.col("lowest") >= 3)  # two candidates
    else:
        allowed = allowed & (F.col("hp") == F.col("cp"))
    return F.when(allowed & error.isNotNull(), F.struct(error, F.col("hp"), F.col("cp")))


def _one_slope(model: str, hinge: str, product: str, square: str) -> Column:
    """Best fit with an unbounded slope on one hinge."""
    slope = F.when(F.col(square) > 0, F.col(product) / F.col(square))
    gain = slope * F.col(product)
    fit = F.struct(
        (F.col("mean_d") - slope * F.col(hinge) / F.col("n")).alias("base_kw"),
        slope.alias("slope_kw_per_f"),
        F.col("hp").alias("breakpoint_f"),
        F.when(F.col("sst") > 0, gain / F.col("sst")).alias("r_squared"),
    )
    return F.min_by(fit, _order(model, F.when(slope.isNotNull(), _error(gain))))


def _two_slopes(rows: DataFrame) -> DataFrame:
    """Non-negative heating and cooling slope per row; adds hs, cs, gain.

    If the free optimum has a negative slope, the bounded one lies on an axis:
    the better single non-negative slope, or none. The hinges never overlap, so
    their raw product is 0 and the centred one comes from the means alone.
    """
    rows = rows.withColumn("hc", -F.col("h1") * F.col("c1") / F.col("n"))
    rows = rows.withColumn("det", F.col("hh") * F.col("cc") - F.col("hc") * F.col("hc"))
    solvable = F.col("det") > 1e-12 * F.col("hh") * F.col("cc")
    rows = rows.withColumns(
        {
            "hs2": F.when(solvable, (F.col("cc") * F.col("hd") - F.col("hc") * F.col("cd")) / F.col("det")),
            "cs2": F.when(solvable, (F.col("hh") * F.col("cd") - F.col("hc") * F.col("hd")) / F.col("det")),
            "hs1": F.when((F.col("hd") > 0) & (F.col("hh") > 0), F.col("hd") / F.col("hh")).otherwise(0.0),
            "cs1": F.when((F.col("cd") > 0) & (F.col("cc") > 0), F.col("cd") / F.col("cc")).otherwise(0.0),
        }
    )
    inner = F.coalesce((F.col("hs2") >= 0) & (F.col("cs2") >= 0), F.lit(False))
    heating = F.col("hs1") * F.col("hd") >= F.col("cs1") * F.col("cd")
    rows = rows.withColumns(
        {
            "hs": F.when(inner, F.col("hs2")).when(heating, F.col("hs1")).otherwise(0.0),
            "cs": F.when(inner, F.col("cs2")).when(heating, 0.0).otherwise(F.col("cs1")),
        }
    )
    return rows.withColumn("gain", F.col("hs") * F.col("hd") + F.col("cs") * F.col("cd"))


def _two_slope_fit(model: str, **breakpoints: Column) -> Column:
    """Best fit with two non-negative slopes."""
    base = F.col("mean_d") - (F.col("hs") * F.col("h1") + F.col("cs") * F.col("c1")) / F.col("n")
    fit = F.struct(
        base.alias("base_kw"),
        F.col("hs").alias("heating_slope_kw_per_f"),
        F.col("cs").alias("cooling_slope_kw_per_f"),
        *[c.alias(name) for name, c in breakpoints.items()],
        F.when(F.col("sst") > 0, F.col("gain") / F.col("sst")).alias("r_squared"),
    )
    return F.min_by(fit, _order(model, _error(F.col("gain"))))


def _line() -> Column:
    """Plain line. If all temperatures are equal, the shortest solution of base + slope * T = mean."""
    flat = F.col("sxx") == 0
    mean_t, mean_d, sxx = F.col("mean_t"), F.col("mean_d"), F.when(F.col("sxx") > 0, F.col("sxx"))
    slope = F.when(flat, mean_d * mean_t / (1 + mean_t * mean_t)).otherwise(F.col("sxy") / sxx)
    gain = F.when(flat, 0.0).otherwise(F.col("sxy") * F.col("sxy") / sxx)
    fit = F.struct(
        F.when(flat, mean_d / (1 + mean_t * mean_t)).otherwise(mean_d - slope * mean_t).alias("base_kw"),
        slope.alias("slope_kw_per_f"),
        F.when(F.col("sst") > 0, gain / F.col("sst")).alias("r_squared"),
    )
    return F.when(F.col("n") >= MIN_POINTS["2p"], fit)


def _best() -> dict[str, Column]:
    """Aggregates over the breakpoints of a meter."""
    return {
        "3p_heating": _one_slope("3p_heating", "h1", "hd", "hh"),
        "3p_cooling": _one_slope("3p_cooling", "c1", "cd", "cc"),
        "4p": _two_slope_fit("4p", breakpoint_f=F.col("hp")),
        "5p": _two_slope_fit("5p", heating_breakpoint_f=F.col("hp"), cooling_breakpoint_f=F.col("cp")),
    }


def _report(fits: DataFrame, model: str) -> DataFrame:
    """A row for every meter; NULL parameters and success = false where no fit exists."""
    return fits.select(
        "meter_id",
        F.col("fit.*"),
        F.col("n").alias("n_points"),
        F.lit(METHODS[model]).alias("method"),
        F.col("fit").isNotNull().alias("success"),
    )


def _fit(rows: DataFrame, model: str) -> DataFrame:
    # Rows arrive sorted by meter; grouping by it alone needs no further sort.
    return _report(rows.groupBy("meter_id").agg(F.first("n").alias("n"), _best()[model].alias("fit")), model)


def fit_2p(points: DataFrame) -> DataFrame:
    """base + slope * T."""
    totals = _paired(points).groupBy("meter_id").agg(*[c.alias(name) for name, c in _totals().items()])
    return _report(totals.withColumn("fit", _line()), "2p")


def fit_3p_heating(points: DataFrame) -> DataFrame:
    """base + slope * max(p - T, 0); the slope may have either sign."""
    return _fit(_hinges(points), "3p_heating")


def fit_3p_cooling(points: DataFrame) -> DataFrame:
    """base + slope * max(T - p, 0); the slope may have either sign."""
    return _fit(_hinges(points), "3p_cooling")


def fit_4p(points: DataFrame) -> DataFrame:
    """base + hs * max(p - T, 0) + cs * max(T - p, 0) with both slopes >= 0."""
    return _fit(_two_slopes(_hinges(points)), "4p")


def fit_5p(points: DataFrame) -> DataFrame:
    """As 4p with two breakpoints, heating at or below cooling."""
    return _fit(_two_slopes(_pairs(_hinges(points))), "5p")


def fit_all(points: DataFrame) -> DataFrame:
    """All five models from one pass, one row per (meter, model), with adjusted r2 where it can be formed."""
    rows = _two_slopes(_pairs(_hinges(points)))
    wide = rows.groupBy("meter_id").agg(
        *[F.first(c).alias(c) for c in TOTALS], *[fit.alias(model) for model, fit in _best().items()]
    )
    wide = wide.withColumn("2p", _line())

    def entry(order: int, model: str) -> Column:
        fields = {f.name for f in wide.schema[model].dataType.fields}
        fit = F.col(f"`{model}`")
        return F.struct(
            F.lit(model).alias("model"),
            F.lit(order).alias("listed"),
            F.lit(PARAMETERS[model]).alias("n_parameters"),
            *[(fit[c] if c in fields else F.lit(None).cast("double")).alias(c) for c in PARAMETER_COLUMNS],
            fit["r_squared"].alias("r_squared"),
            F.col("n").alias("n_points"),
            fit.isNotNull().alias("success"),
        )

    fits = wide.select("meter_id", F.inline(F.array(*[entry(i, m) for i, m in enumerate(PARAMETERS)])))
    spare = F.col("n_points") - F.col("n_parameters") - 1
    return fits.withColumn(
        "adjusted_r_squared",
        F.when(
            F.col("success") & (spare > 0), 1 - (1 - F.col("r_squared")) * (F.col("n_points") - 1) / spare
        ),
    )


def select_model(points: DataFrame) -> DataFrame:
    """All candidates with is_selected: best adjusted r2, then fewer parameters, then the listed order.

    Adjusted r2 that agree to 1e-9 are equal.
    """
    order = Window.partitionBy("meter_id").orderBy(F.desc_nulls_last("score"), "n_parameters", "listed")
    ranked = fit_all(points).withColumn("score", F.round("adjusted_r_squared", EQUAL_DIGITS))
    ranked = ranked.withColumn("place", F.row_number().over(order))
    return ranked.withColumn(
        "is_selected", (F.col("place") == 1) & F.col("score").isNotNull()
    ).drop("score", "place", "listed")
