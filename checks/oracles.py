"""DuckDB SQL for the queries, written over whole series and without the library's plans."""

from __future__ import annotations

from checks.queries import BANDS, HOLIDAYS, OFF_EDGE

ORACLES: dict[str, str] = {}

# name -> (tables it reads, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": ((), """
        SELECT *, CAST(35 + (day(timestamp) * 17) % 40 + (12 - abs(hour(timestamp) - 15)) AS DOUBLE) AS temperature_f
        FROM (SELECT 'm' || user_id AS meter_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS timestamp,
                     round(sum(value), 2) AS demand_kw
              FROM events GROUP BY ALL)"""),
    "feeders": ((), """
        SELECT event_type AS meter_id,
               date_trunc('hour', ts) + INTERVAL 15 MINUTE * CAST(floor(minute(ts) / 15) + 1 AS INT) AS timestamp,
               round(sum(value), 2) AS demand_kw
        FROM events GROUP BY ALL"""),
    "raw_texts": ((), """
        SELECT CASE WHEN props = '{"k": 13}' THEN 'not a time'
                    ELSE strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') END AS read_at,
               CASE WHEN props <> '{"k": 7}' THEN 'm' || user_id END AS device,
               CASE WHEN value > 250 THEN 'out of range' WHEN value < 1 THEN '-' || value
                    ELSE CAST(value AS VARCHAR) END AS kw,
               event_id AS line, event_type AS channel
        FROM events"""),
    "canonical": (("raw_texts",), """
        SELECT try_cast(read_at AS TIMESTAMP) AS timestamp, device AS meter_id, try_cast(kw AS DOUBLE) AS demand_kw,
               kw, line, channel
        FROM raw_texts"""),
    "weather": ((), """
        SELECT DISTINCT date_trunc('hour', ts) AS timestamp,
               CAST(35 + (day(ts) * 17) % 40 + (12 - abs(hour(ts) - 15)) AS DOUBLE) AS temperature_f
        FROM events"""),
    "grid": (("readings",), """
        SELECT meter_id, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp
        FROM readings GROUP BY meter_id"""),
    "around": (("grid", "readings"), """
        SELECT meter_id, timestamp, demand_kw AS kw, temperature_f AS tf,
               last_value(demand_kw IGNORE NULLS) OVER up AS pv, first_value(demand_kw IGNORE NULLS) OVER down AS nv,
               last_value(CASE WHEN demand_kw IS NOT NULL THEN timestamp END IGNORE NULLS) OVER up AS pt,
               first_value(CASE WHEN demand_kw IS NOT NULL THEN timestamp END IGNORE NULLS) OVER down AS nt,
               last_value(temperature_f IGNORE NULLS) OVER up AS ptf,
               first_value(temperature_f IGNORE NULLS) OVER down AS ntf
        FROM grid LEFT JOIN readings USING (meter_id, timestamp)
        WINDOW up AS (PARTITION BY meter_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING),
               down AS (PARTITION BY meter_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
    "obs": (("around",), """
        SELECT *, kw IS NOT NULL AS is_observed, kw IS NULL AND analysis_demand_kw IS NOT NULL AS is_interpolated,
               CASE WHEN kw IS NOT NULL THEN 'observed' WHEN analysis_demand_kw IS NOT NULL THEN 'interpolated'
                    ELSE 'missing' END AS data_quality_flag
        FROM (SELECT meter_id, timestamp, kw,
                     CASE WHEN kw IS NOT NULL THEN kw
                          WHEN nv IS NOT NULL AND pos <= 4 THEN pv + (nv - pv) * pos / len END AS analysis_demand_kw,
                     CASE WHEN tf IS NOT NULL THEN tf
                          WHEN ntf IS NOT NULL AND pos <= 4 THEN ptf + (ntf - ptf) * pos / len END AS temperature_f
              FROM (SELECT *, datediff('hour', pt, timestamp) AS pos, datediff('hour', pt, nt) AS len FROM around))"""),
    "gap_runs": (("obs",), """
        SELECT meter_id, count(*) AS gap_intervals, min(timestamp) AS gap_start, max(timestamp) AS gap_end
        FROM (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY timestamp)
                      - row_number() OVER (PARTITION BY meter_id, is_observed ORDER BY timestamp) AS island FROM obs)
        WHERE NOT is_observed GROUP BY meter_id, island"""),
    "feeder_around": (("feeders",), """
        SELECT meter_id, timestamp, demand_kw AS kw,
               last_value(demand_kw IGNORE NULLS) OVER up AS pv, first_value(demand_kw IGNORE NULLS) OVER down AS nv,
               datediff('minute', last_value(CASE WHEN demand_kw IS NOT NULL THEN timestamp END IGNORE NULLS) OVER up,
                        timestamp) // 15 AS pos,
               datediff('minute', timestamp,
                        first_value(CASE WHEN demand_kw IS NOT NULL THEN timestamp END IGNORE NULLS) OVER down) // 15 AS togo
        FROM (SELECT meter_id, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 15 MINUTE)) AS timestamp
              FROM feeders GROUP BY meter_id) LEFT JOIN feeders USING (meter_id, timestamp)
        WINDOW up AS (PARTITION BY meter_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING),
               down AS (PARTITION BY meter_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
    "group_members": ((), """
        SELECT n_name AS group_name, 'm' || c_custkey AS meter_id FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL SELECT c_mktsegment, 'm' || c_custkey FROM customer"""),
    "group_children": ((), """
        SELECT r_name AS parent, n_name AS child FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'World', r_name FROM region"""),
    "resolved": (("group_members", "group_children"), """
        SELECT DISTINCT group_name, meter_id FROM (
          WITH RECURSIVE reach(top, name) AS (
            SELECT DISTINCT group_name, group_name FROM group_members
            UNION SELECT parent, parent FROM group_children
            UNION SELECT top, child FROM reach JOIN group_children ON parent = name)
          SELECT top AS group_name, meter_id FROM reach JOIN group_members ON name = group_name)"""),
    "portfolio": ((), "SELECT 'm' || c_custkey AS meter_id FROM customer WHERE NOT c_acctbal < 0"),
    "joint": (("resolved", "portfolio"), """
        SELECT group_name AS entity_id, meter_id FROM resolved UNION ALL SELECT 'Portfolio', meter_id FROM portfolio"""),
    "load": (("obs", "joint"), """
        SELECT meter_id AS entity_id, timestamp, analysis_demand_kw AS demand_kw,
               CASE WHEN analysis_demand_kw IS NULL THEN 0 ELSE 1 END AS n_meters_reporting
        FROM obs JOIN (SELECT 'm' || c_custkey AS meter_id FROM customer) USING (meter_id)
        UNION ALL
        SELECT entity_id, timestamp, sum(analysis_demand_kw), count(analysis_demand_kw)
        FROM obs JOIN joint USING (meter_id) GROUP BY entity_id, timestamp"""),
    "daily": (("load",), """
        SELECT entity_id, CAST(timestamp AS DATE) AS date, timestamp, demand_kw,
               row_number() OVER (PARTITION BY entity_id, CAST(timestamp AS DATE) ORDER BY timestamp) - 1 AS interval_index,
               hour(timestamp) * 60 + minute(timestamp) AS minute_of_day,
               strftime(timestamp, '%H:%M:%S') AS time_of_day,
               count(*) OVER day = 24 AND count(demand_kw) OVER day = 24 AS is_complete_day
        FROM load WINDOW day AS (PARTITION BY entity_id, CAST(timestamp AS DATE))"""),
    "features": (("daily",), """
        SELECT entity_id, date, avg(demand_kw) AS mean_demand_kw, max(demand_kw) AS maximum_demand_kw,
               min(demand_kw) AS minimum_demand_kw, coalesce(sum(demand_kw), 0) AS daily_energy_kwh,
               min(CASE WHEN demand_kw = day_max THEN minute_of_day END) AS peak_minute,
               CASE WHEN max(demand_kw) > 0 THEN avg(demand_kw) / max(demand_kw) END AS load_factor,
               CASE WHEN avg(demand_kw) > 0 THEN max(demand_kw) / avg(demand_kw) END AS peak_to_average_ratio,
               stddev_samp(demand_kw) AS standard_deviation_kw,
               CASE WHEN avg(demand_kw) > 0 THEN stddev_samp(demand_kw) / avg(demand_kw) END AS coefficient_of_variation,
               bool_or(is_complete_day) AS is_complete_day
        FROM (SELECT *, max(demand_kw) OVER (PARTITION BY entity_id, date) AS day_max FROM daily)
        GROUP BY entity_id, date"""),
    "segments": (("daily",), """
        SELECT entity_id, date,
               max(demand_kw) FILTER (hour(timestamp) BETWEEN 6 AND 9) AS morning_peak_kw,
               max(demand_kw) FILTER (hour(timestamp) BETWEEN 10 AND 13) AS midday_peak_kw,
               max(demand_kw) FILTER (hour(timestamp) BETWEEN 14 AND 17) AS afternoon_peak_kw,
               max(demand_kw) FILTER (hour(timestamp) BETWEEN 18 AND 21) AS evening_peak_kw,
               avg(demand_kw) FILTER (hour(timestamp) NOT BETWEEN 6 AND 21) AS overnight_mean_kw,
               avg(demand_kw) FILTER (hour(timestamp) NOT BETWEEN 6 AND 21) AS nighttime_mean_kw,
               avg(demand_kw) FILTER (hour(timestamp) BETWEEN 6 AND 21) AS daytime_mean_kw
        FROM daily GROUP BY entity_id, date"""),
    "extrema": (("load",), """
        SELECT entity_id, timestamp,
               coalesce(demand_kw > lag(demand_kw) OVER w AND demand_kw > lead(demand_kw) OVER w, false) AS is_peak,
               coalesce(demand_kw < lag(demand_kw) OVER w AND demand_kw < lead(demand_kw) OVER w, false) AS is_valley
        FROM load WINDOW w AS (PARTITION BY entity_id ORDER BY timestamp)"""),
    "shape_flags": (("daily", "features", "segments", "extrema"), """
        SELECT entity_id, date,
               coalesce(coefficient_of_variation <= 0.15, false) AS is_flat,
               coalesce(peak_to_average_ratio >= 2.0, false) AS is_highly_peaked,
               coalesce(maximum_demand_kw > 0 AND morning_peak_kw >= 0.85 * maximum_demand_kw, false) AS has_morning_peak,
               coalesce(maximum_demand_kw > 0 AND midday_peak_kw >= 0.85 * maximum_demand_kw, false) AS has_midday_peak,
               coalesce(maximum_demand_kw > 0 AND afternoon_peak_kw >= 0.85 * maximum_demand_kw, false) AS has_afternoon_peak,
               coalesce(maximum_demand_kw > 0 AND evening_peak_kw >= 0.85 * maximum_demand_kw, false) AS has_evening_peak,
               coalesce(daytime_mean_kw > 0 AND overnight_mean_kw / daytime_mean_kw >= 1.1, false) AS is_overnight_heavy,
               n_peaks >= 2 AS is_multi_peak,
               coalesce(maximum_demand_kw > 0 AND n_high / n_rows <= 0.10, false) AS has_sharp_peak,
               coalesce(maximum_demand_kw > 0 AND n_high / n_rows >= 0.30, false) AS has_sustained_high_load,
               n_peaks >= 1 AND n_valleys >= 1 AS has_peak_valley_pattern,
               n_present / n_rows < 0.5 AS is_unusual
        FROM features JOIN segments USING (entity_id, date)
        JOIN (SELECT d.entity_id, d.date, count(*) AS n_rows, count(d.demand_kw) AS n_present,
                     count_if(d.demand_kw >= 0.9 * f.maximum_demand_kw) AS n_high,
                     count_if(is_peak) AS n_peaks, count_if(is_valley) AS n_valleys
              FROM daily d JOIN extrema USING (entity_id, timestamp) JOIN features f ON f.entity_id = d.entity_id AND f.date = d.date
              GROUP BY ALL) USING (entity_id, date)"""),
    "shapes": (("shape_flags",), """
        SELECT *, CASE
            WHEN is_unusual THEN 'insufficient_data'
            WHEN is_highly_peaked AND has_sharp_peak AND has_morning_peak AND NOT has_afternoon_peak AND NOT has_evening_peak
              THEN 'morning_peak'
            WHEN is_highly_peaked AND has_sharp_peak AND has_afternoon_peak AND NOT has_evening_peak THEN 'afternoon_peak'
            WHEN is_highly_peaked AND has_sharp_peak AND has_evening_peak THEN 'evening_peak'
            WHEN is_highly_peaked AND has_sharp_peak AND has_midday_peak THEN 'midday_peak'
            WHEN is_multi_peak THEN 'multi_peak' WHEN is_overnight_heavy THEN 'overnight_heavy'
            WHEN is_flat THEN 'flat' ELSE 'mixed_other' END AS primary_shape
        FROM shape_flags"""),
    "timing": (("features",), """
        SELECT *, sum(frequency) OVER (PARTITION BY entity_id) AS n_days,
               row_number() OVER (PARTITION BY entity_id ORDER BY bucket) - 1 AS number
        FROM (SELECT entity_id, peak_minute // 30 * 30 AS bucket, count(*) AS frequency,
                     string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) AS dates
              FROM features WHERE is_complete_day AND peak_minute IS NOT NULL GROUP BY ALL)"""),
    "shape_groups": (("shapes",), """
        SELECT *, sum(frequency) OVER (PARTITION BY entity_id) AS n_days,
               row_number() OVER (PARTITION BY entity_id ORDER BY primary_shape) - 1 AS number
        FROM (SELECT entity_id, primary_shape, count(*) AS frequency,
                     string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) AS dates
              FROM shapes GROUP BY ALL)"""),
    "outliers": (("features",), """
        SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY metric_no, date) - 1 AS number
        FROM (SELECT *, (value - avg(value) OVER w) / stddev_samp(value) OVER w AS z, count(*) OVER w AS n_days,
                     stddev_samp(value) OVER w AS sd
              FROM (SELECT entity_id, date, 0 AS metric_no, 'daily_energy_kwh' AS metric, daily_energy_kwh AS value
                    FROM features WHERE is_complete_day
                    UNION ALL SELECT entity_id, date, 1, 'maximum_demand_kw', maximum_demand_kw FROM features
                    WHERE is_complete_day)
              WINDOW w AS (PARTITION BY entity_id, metric_no))
        WHERE n_days >= 5 AND sd > 0 AND abs(z) >= 2.5"""),
    "placed": (("load",), """
        SELECT entity_id, timestamp, demand_kw, coalesce(demand_kw >= 50, false) AS q,
               row_number() OVER (PARTITION BY entity_id ORDER BY timestamp) AS ix FROM load"""),
    "numbered": (("placed",), """
        SELECT entity_id, ix AS hit,
               sum(CASE WHEN before IS NULL OR ix - before - 1 > 1 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY entity_id ORDER BY ix) - 1 AS number
        FROM (SELECT *, lag(ix) OVER (PARTITION BY entity_id ORDER BY ix) AS before FROM placed WHERE q)"""),
    "events_found": (("placed", "numbered"), """
        SELECT entity_id || '_threshold_50_' || format('{:04d}', CAST(number AS BIGINT))
                 AS event_id,
               entity_id, 'threshold_50' AS peak_definition, min(timestamp) AS start_time, max(timestamp) AS end_time,
               datediff('minute', min(timestamp), max(timestamp)) / 60 AS duration_hours,
               max(demand_kw) AS maximum_demand_kw, avg(demand_kw) AS mean_demand_kw, min(demand_kw) AS minimum_demand_kw,
               count(*) AS n_intervals
        FROM (SELECT entity_id, number, min(hit) AS a, max(hit) AS b FROM numbered GROUP BY ALL)
        JOIN placed USING (entity_id) WHERE ix BETWEEN a AND b GROUP BY entity_id, number"""),
    "points": (("obs",), """
        SELECT meter_id, CAST(timestamp AS DATE) AS date, avg(temperature_f) AS temperature_f,
               avg(analysis_demand_kw) AS demand_kw
        FROM obs WHERE isodow(timestamp) <= 5 GROUP BY ALL"""),
    "pairs": (("points",), """
        SELECT meter_id, round(temperature_f + 0.00000003, 6) AS t, round(demand_kw + 0.00000003, 6) AS d FROM points
        WHERE temperature_f IS NOT NULL AND demand_kw IS NOT NULL"""),
    "sizes": (("points", "pairs"), """
        SELECT meter_id, coalesce(n, 0) AS n, sst, md FROM (SELECT DISTINCT meter_id FROM points)
        LEFT JOIN (SELECT meter_id, count(*) AS n, avg(d) AS md, sum(d * d) - count(*) * avg(d) * avg(d) AS rough,
                          regr_syy(d, t) AS sst FROM pairs GROUP BY meter_id) USING (meter_id)"""),
    "degrees": (("pairs",), """
        SELECT meter_id, CAST(unnest(generate_series(CAST(floor(min(t)) AS INT) + 1, CAST(ceil(max(t)) AS INT) - 1)) AS DOUBLE) AS p
        FROM pairs GROUP BY meter_id"""),
    # One hinge, straight from the points: least squares on (x, d).
    "single": (("pairs", "degrees"), """
        SELECT meter_id, kind, p, count(*) AS n, regr_slope(d, x) AS slope, regr_intercept(d, x) AS base,
               CASE WHEN regr_syy(d, x) > 0 THEN regr_sxy(d, x) ^ 2 / regr_sxx(d, x) / regr_syy(d, x) END AS r2
        FROM (SELECT meter_id, p, d, 'cooling' AS kind, greatest(t - p, 0) AS x FROM pairs JOIN degrees USING (meter_id)
              UNION ALL SELECT meter_id, p, d, 'heating', greatest(p - t, 0) FROM pairs JOIN degrees USING (meter_id))
        GROUP BY meter_id, kind, p HAVING count(*) >= 5"""),
    "single_best": (("single",), """
        SELECT * FROM single
        QUALIFY row_number() OVER (PARTITION BY meter_id, kind ORDER BY round(1 - coalesce(r2, 1), 9), p) = 1"""),
    # Two hinges: normal equations on centred columns; outside the quadrant the better axis.
    "double": (("pairs", "degrees"), """
        SELECT meter_id, hp, cp, n, sst, mh, mc, md,
               CASE WHEN inner_ok THEN hs2 WHEN axis_h THEN hs1 ELSE 0 END AS hs,
               CASE WHEN inner_ok THEN cs2 WHEN axis_h THEN 0 ELSE cs1 END AS cs, hd, cd
        FROM (SELECT *, coalesce(hs2 >= 0 AND cs2 >= 0, false) AS inner_ok, hs1 * hd >= cs1 * cd AS axis_h
              FROM (SELECT *, CASE WHEN det > 1e-12 * hh * cc THEN (cc * hd - hc * cd) / det END AS hs2,
                           CASE WHEN det > 1e-12 * hh * cc THEN (hh * cd - hc * hd) / det END AS cs2,
                           CASE WHEN hd > 0 AND hh > 0 THEN hd / hh ELSE 0 END AS hs1,
                           CASE WHEN cd > 0 AND cc > 0 THEN cd / cc ELSE 0 END AS cs1
                    FROM (SELECT *, hh * cc - hc * hc AS det
                          FROM (SELECT meter_id, hp, cp, count(*) AS n, regr_syy(d, h) AS sst, avg(h) AS mh, avg(c) AS mc,
                                       avg(d) AS md, regr_sxx(d, h) AS hh, regr_sxx(d, c) AS cc, regr_sxy(c, h) AS hc,
                                       regr_sxy(d, h) AS hd, regr_sxy(d, c) AS cd
                                FROM (SELECT a.meter_id, a.p AS hp, b.p AS cp, d, greatest(a.p - t, 0) AS h,
                                             greatest(t - b.p, 0) AS c
                                      FROM degrees a JOIN degrees b ON a.meter_id = b.meter_id AND a.p <= b.p
                                      JOIN pairs ON pairs.meter_id = a.meter_id)
                                GROUP BY meter_id, hp, cp))))"""),
    "double_fit": (("double",), """
        SELECT *, md - hs * mh - cs * mc AS base, CASE WHEN sst > 0 THEN (hs * hd + cs * cd) / sst END AS r2 FROM double"""),
    "best_4p": (("double_fit",), """
        SELECT * FROM double_fit WHERE hp = cp AND n >= 8
        QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY round(1 - coalesce(r2, 1), 9), hp) = 1"""),
    "best_5p": (("double_fit",), """
        SELECT * FROM double_fit WHERE n >= 10
        QUALIFY count(*) OVER (PARTITION BY meter_id) > 1
            AND row_number() OVER (PARTITION BY meter_id ORDER BY round(1 - coalesce(r2, 1), 9), hp, cp) = 1"""),
    "line": (("pairs",), """
        SELECT meter_id, count(*) AS n, regr_sxx(d, t) = 0 AS flat,
               CASE WHEN flat THEN avg(d) * avg(t) / (1 + avg(t) * avg(t)) ELSE regr_slope(d, t) END AS slope,
               CASE WHEN flat THEN avg(d) / (1 + avg(t) * avg(t)) ELSE regr_intercept(d, t) END AS base,
               CASE WHEN regr_syy(d, t) > 0 THEN
                 CASE WHEN flat THEN 0 ELSE regr_sxy(d, t) ^ 2 / regr_sxx(d, t) / regr_syy(d, t) END END AS r2
        FROM pairs GROUP BY meter_id HAVING count(*) >= 4"""),
    "candidates": (("sizes", "line", "single_best", "best_4p", "best_5p"), """
        SELECT meter_id, model, s.n AS n_points, f.r2 AS r_squared, f.fitted IS NOT NULL AS success, p, listed,
               CASE WHEN s.n - p - 1 > 0 THEN 1 - (1 - f.r2) * (s.n - 1) / (s.n - p - 1) END AS adjusted_r_squared
        FROM sizes s
        CROSS JOIN (VALUES ('2p', 2, 0), ('3p_heating', 3, 1), ('3p_cooling', 3, 2), ('4p', 4, 3), ('5p', 5, 4)) m(model, p, listed)
        LEFT JOIN (SELECT meter_id, '2p' AS model, r2, 1 AS fitted FROM line
                   UNION ALL SELECT meter_id, '3p_' || kind, r2, 1 FROM single_best
                   UNION ALL SELECT meter_id, '4p', r2, 1 FROM best_4p
                   UNION ALL SELECT meter_id, '5p', r2, 1 FROM best_5p) f USING (meter_id, model)"""),
    "vectors": (("daily",), """
        SELECT entity_id, kind, date, list(v ORDER BY interval_index) AS vector
        FROM (SELECT entity_id, date, interval_index, 'absolute' AS kind, demand_kw AS v FROM daily WHERE is_complete_day
              UNION ALL
              SELECT entity_id, date, interval_index, 'normalized',
                     CASE WHEN max(demand_kw) OVER (PARTITION BY entity_id, date) > 0
                          THEN demand_kw / max(demand_kw) OVER (PARTITION BY entity_id, date) END
              FROM daily WHERE is_complete_day)
        GROUP BY ALL HAVING count(v) = count(*)"""),
    "near": (("obs",), """
        SELECT meter_id, timestamp FROM (SELECT *, max(analysis_demand_kw) OVER (PARTITION BY meter_id) AS peak FROM obs)
        WHERE analysis_demand_kw >= 0.5 * peak"""),
    "joint_load": (("obs", "joint"), """
        SELECT entity_id, timestamp, sum(analysis_demand_kw) AS aggregate_demand_kw
        FROM obs JOIN joint USING (meter_id) GROUP BY ALL"""),
}


def r(expression: str, name: str | None = None) -> str:
    """The rounding of checks.queries.settled."""
    return f"round({expression} + {OFF_EDGE:.8f}, 6) AS {name or expression}"


def sql(body: str, *names: str) -> str:
    """`body` with the tables it names, in order of their needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in ordered)
    return f"WITH {ctes}\n{body.strip()}"


def oracle(key: str, body: str, *names: str) -> None:
    ORACLES[key] = sql(body, *names)


QUALITY = f"""meter_id, timestamp, {r('kw', 'observed_demand_kw')},
    {r('CASE WHEN kw IS NULL THEN analysis_demand_kw END', 'interpolated_demand_kw')}, {r('analysis_demand_kw')},
    is_observed, is_interpolated, data_quality_flag"""

oracle("read_readings", f"SELECT user_id, ts, {r('value')} FROM events")
oracle("canonicalize", f"SELECT timestamp, meter_id, {r('demand_kw')}, line, channel FROM canonical", "canonical")
oracle("read_weather", f"""
SELECT timestamp, {r("CASE WHEN temperature_f <= 70 THEN temperature_f END", "temperature_f")}
FROM weather WHERE hour(timestamp) <> 3""", "weather")
oracle("write_outputs", f"SELECT entity_id, date, {r('daily_energy_kwh')}, is_complete_day FROM features", "features")

for kind in ("csv", "per_entity"):
    oracle(f"write_outputs_{kind}", f"SELECT entity_id, date, {r('daily_energy_kwh')}, is_complete_day FROM features", "features")
oracle("timestamp_patterns", """
SELECT file, pattern, n_given, n_given AS n_parsed, CASE WHEN file = 'error' THEN 'd/M/yyyy H:mm[:ss]' ELSE '' END AS ambiguous_with
FROM (SELECT event_type AS file,
             count(CASE WHEN event_type <> 'error' OR day(date_trunc('hour', ts) + INTERVAL 1 HOUR) <= 12 THEN 1 END) AS n_given
      FROM events GROUP BY 1)
JOIN (VALUES ('click', 'yyyy-MM-dd HH:mm:ss'), ('view', 'M/d/yyyy H:mm[:ss]'), ('error', 'M/d/yyyy H:mm[:ss]'),
             ('purchase', 'd/M/yyyy H:mm[:ss]'), ('signup', 'd.M.yyyy H:mm[:ss]')) ways(file, pattern) USING (file)""")
oracle("canonicalize_auto", f"""
SELECT CASE WHEN event_type <> 'error' OR day(hour_end) <= 12 THEN hour_end END AS timestamp, 'm' || user_id AS meter_id,
       {r('value', 'demand_kw')}, event_id AS line, event_type AS channel
FROM (SELECT *, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end FROM events)""")

FINDINGS = """
SELECT severity, n || ' ' || message AS message, 'ingestion' AS section, n FROM (
  SELECT 'ERROR' AS severity, 'timestamp value(s) failed to parse' AS message, count_if(timestamp IS NULL) AS n FROM canonical
  UNION ALL SELECT 'ERROR', 'demand_kw value(s) are nonnumeric', count_if(demand_kw IS NULL AND kw IS NOT NULL) FROM canonical
  UNION ALL SELECT 'WARNING', 'negative demand_kw value(s) detected; negative demand is not supported',
                   count_if(demand_kw < 0) FROM canonical
  UNION ALL SELECT 'ERROR', 'row(s) missing meter_id', count_if(meter_id IS NULL) FROM canonical
  UNION ALL SELECT 'ERROR', 'duplicate (meter_id, timestamp) record(s) detected', sum(k - 1)
            FROM (SELECT count(*) AS k FROM canonical GROUP BY meter_id, timestamp))
WHERE n > 0"""
oracle("validate_readings", FINDINGS, "canonical")
oracle("finding_gate", f"SELECT * FROM ({FINDINGS}) WHERE message NOT LIKE '%duplicate%'", "canonical")
oracle("dedupe_readings", f"""
SELECT timestamp, meter_id, {r('demand_kw')}, line, channel FROM canonical
QUALIFY row_number() OVER (PARTITION BY meter_id, timestamp ORDER BY line) = 1""", "canonical")

RESOLUTION = """
SELECT meter_id, min(minutes) FILTER (place = 1) AS interval_minutes,
       coalesce(sum(n) FILTER (place > 1 AND minutes IS NOT NULL), 0) AS n_irregular_gaps,
       max(extra) AS n_duplicate_timestamps
FROM (SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY minutes IS NULL, n DESC, minutes) AS place
      FROM (SELECT meter_id, CASE WHEN minutes > 0 THEN minutes END AS minutes, count(*) AS n, max(extra) AS extra
            FROM (SELECT meter_id,
                         datediff('minute', lag(timestamp) OVER (PARTITION BY meter_id ORDER BY timestamp), timestamp) AS minutes,
                         count(*) OVER m - approx AS extra
                  FROM canonical JOIN (SELECT meter_id, count(DISTINCT timestamp) AS approx FROM canonical GROUP BY ALL) USING (meter_id)
                  WHERE timestamp IS NOT NULL AND meter_id IS NOT NULL WINDOW m AS (PARTITION BY meter_id))
            GROUP BY 1, 2))
GROUP BY meter_id"""
oracle("detect_resolution", RESOLUTION, "canonical")
oracle("overall_resolution", f"""
WITH per_meter AS ({RESOLUTION})
SELECT (SELECT interval_minutes FROM per_meter WHERE interval_minutes IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS expected_interval_minutes,
       count(DISTINCT interval_minutes) > 1 AS is_mixed_resolution,
       sum(n_irregular_gaps) AS n_irregular_gaps, sum(n_duplicate_timestamps) AS n_duplicate_timestamps
FROM per_meter""".replace("WITH per_meter AS", ", per_meter AS"), "canonical")
ORACLES["overall_resolution"] = ORACLES["overall_resolution"].replace(")\n, per_meter", "),\nper_meter")

oracle("calendar_features", f"""
SELECT meter_id, timestamp, CAST(timestamp AS DATE) AS date, year(timestamp) AS year, month(timestamp) AS month,
       day(timestamp) AS day, dayofyear(timestamp) AS day_of_year, hour(timestamp) AS hour, minute(timestamp) AS minute,
       isodow(timestamp) - 1 AS day_of_week, dayname(timestamp) AS day_name, isodow(timestamp) <= 5 AS is_weekday,
       isodow(timestamp) > 5 AS is_weekend,
       CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'winter' WHEN month(timestamp) <= 5 THEN 'spring'
            WHEN month(timestamp) <= 8 THEN 'summer' ELSE 'fall' END AS season,
       CASE WHEN CAST(timestamp AS DATE) IN ({', '.join(f"DATE '{h}'" for h in HOLIDAYS)}) THEN 'holiday'
            WHEN isodow(timestamp) <= 5 THEN 'weekday' ELSE 'weekend' END AS day_type
FROM readings""", "readings")
oracle("interval_energy", f"""
SELECT meter_id, timestamp, {r('analysis_demand_kw')}, {r('analysis_demand_kw * 60 / 60', 'energy_kwh')} FROM obs""", "obs")
oracle("group_tree_check", """
, edges AS (SELECT * FROM group_children
   UNION ALL SELECT n_name, r_name FROM nation JOIN region ON n_nationkey = r_regionkey
   UNION ALL SELECT r_name, 'AREA_' || r_regionkey FROM region
   UNION ALL SELECT 'World', 'World' FROM region WHERE r_name = 'ASIA'),
listed AS (SELECT 'm' || c_custkey AS meter_id FROM customer
   UNION ALL SELECT 'm' || c_custkey FROM customer WHERE c_acctbal < 0
   UNION ALL SELECT NULL FROM customer WHERE c_acctbal > 9900
   UNION ALL SELECT n_name FROM nation WHERE n_name > 'U'),
named AS (SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region
   UNION ALL SELECT CASE WHEN r_name = 'ASIA' THEN 'World' END FROM region
   UNION ALL SELECT 'Portfolio' FROM region WHERE r_name = 'EUROPE'),
in_groups AS (SELECT * FROM group_members
   UNION ALL SELECT n_name, 's' || s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
walks AS (WITH RECURSIVE walk(top, name) AS (SELECT parent, child FROM edges WHERE parent <> child
   UNION SELECT top, child FROM walk JOIN edges ON parent = name AND parent <> child) SELECT * FROM walk)
SELECT 'ERROR' AS severity, message, section, n FROM (
  SELECT 'A meter entry is missing meter_id' AS message, 'meters' AS section, count(*) AS n
  FROM listed WHERE meter_id IS NULL HAVING count(*) > 0
  UNION ALL SELECT 'Duplicate meter_id: ' || meter_id, 'meters', count(*) FROM listed WHERE meter_id IS NOT NULL
            GROUP BY meter_id HAVING count(*) > 1
  UNION ALL SELECT 'A group entry is missing name', 'meter_groups', count(*) FROM named WHERE name IS NULL HAVING count(*) > 0
  UNION ALL SELECT 'Group ''' || group_name || ''' references unknown meter_id ''' || meter_id || '''', 'meter_groups', count(*)
            FROM in_groups WHERE meter_id NOT IN (SELECT meter_id FROM listed WHERE meter_id IS NOT NULL)
            GROUP BY group_name, meter_id
  UNION ALL SELECT 'Group ''' || parent || ''' references unknown child group ''' || child || '''', 'meter_groups', count(*)
            FROM edges WHERE child NOT IN (SELECT name FROM named WHERE name IS NOT NULL) GROUP BY parent, child
  UNION ALL SELECT 'Group ''' || parent || ''' lists itself as a child group', 'meter_groups', count(*)
            FROM edges WHERE parent = child GROUP BY parent
  UNION ALL SELECT 'Cyclic group hierarchy involving ''' || top || '''', 'meter_groups', 1 FROM walks WHERE top = name
  UNION ALL SELECT 'Several kinds of entity have the id ''' || id || '''', 'meter_groups', count(*) FROM (
              SELECT meter_id AS id, 'meter' AS kind FROM listed UNION SELECT name, 'group' FROM named
              UNION SELECT group_name, 'group' FROM in_groups UNION SELECT parent, 'group' FROM edges
              UNION SELECT 'Portfolio', 'portfolio')
            WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)""",
       "group_children", "group_members")
ORACLES["group_tree_check"] = ORACLES["group_tree_check"].replace(")\n, edges", "),\nedges")

oracle("regular_grid", "SELECT meter_id, timestamp FROM grid", "grid")
oracle("fill_gaps", f"SELECT {QUALITY} FROM obs", "obs")
FILLED = """
SELECT meter_id, timestamp, kw, analysis_demand_kw, kw IS NOT NULL AS is_observed,
       kw IS NULL AND analysis_demand_kw IS NOT NULL AS is_interpolated,
       CASE WHEN kw IS NOT NULL THEN 'observed' WHEN analysis_demand_kw IS NOT NULL THEN 'interpolated'
            ELSE 'missing' END AS data_quality_flag
FROM (SELECT *, {value} AS analysis_demand_kw FROM feeder_around)"""
oracle("fill_gaps_quarter_hours", f"""SELECT {QUALITY} FROM ({FILLED.format(value='''
    CASE WHEN kw IS NOT NULL THEN kw WHEN pos <= 2 AND togo IS NOT NULL THEN pv + (nv - pv) * pos / (pos + togo) END''')})""",
       "feeder_around")
oracle("fill_gaps_ffill_bfill", f"""SELECT {QUALITY} FROM ({FILLED.format(value='''
    CASE WHEN kw IS NOT NULL THEN kw
         WHEN pos <= 2 AND togo IS NOT NULL THEN pv + (nv - pv) * 1 / (pos + togo)
         WHEN pos <= 1 THEN pv
         WHEN togo <= 1 THEN nv END''')})""", "feeder_around")
oracle("fill_temperature", f"SELECT meter_id, timestamp, {r('temperature_f')} FROM obs", "obs")
oracle("gap_runs", "SELECT * FROM gap_runs", "gap_runs")
oracle("quality_summary", f"""
, counts AS (SELECT meter_id, count(*) AS n, count_if(is_observed) AS o, count_if(is_interpolated) AS i FROM obs GROUP BY ALL),
worst AS (SELECT * FROM gap_runs QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY gap_intervals DESC, gap_start) = 1),
runs AS (SELECT meter_id, count(*) AS k FROM gap_runs GROUP BY ALL),
meters AS (SELECT meter_id, n, o, i, coalesce(k, 0) AS k, coalesce(gap_intervals, 0) AS g, gap_start, gap_end
           FROM counts LEFT JOIN worst USING (meter_id) LEFT JOIN runs USING (meter_id)),
total AS (SELECT 'PORTFOLIO' AS meter_id, sum(n) AS n, sum(o) AS o, sum(i) AS i, sum(k) AS k FROM meters),
top AS (SELECT g, gap_start, gap_end FROM meters ORDER BY g DESC, meter_id LIMIT 1),
both_levels AS (SELECT * FROM meters UNION ALL SELECT total.*, top.* FROM total CROSS JOIN top)
SELECT meter_id, n AS n_intervals, o AS n_observed, {r('round_even(100 * o / n, 2)', 'pct_observed')},
       i AS n_interpolated, {r('round_even(100 * i / n, 2)', 'pct_interpolated')},
       n - o - i AS n_missing, {r('round_even(100 * (n - o - i) / n, 2)', 'pct_missing')},
       k AS n_gap_events, g AS max_gap_intervals, gap_start AS max_gap_start, gap_end AS max_gap_end
FROM both_levels""", "gap_runs")
ORACLES["quality_summary"] = ORACLES["quality_summary"].replace(")\n, counts", "),\ncounts")
oracle("quality_detail", "SELECT meter_id, timestamp, data_quality_flag FROM obs WHERE NOT is_observed", "obs")
oracle("quality_flag_counts", "SELECT data_quality_flag, count(*) AS n_intervals FROM obs GROUP BY 1", "obs")

NEAREST = """
SELECT f.meter_id, f.timestamp, f.demand_kw,
       arg_min(w.temperature_f, (abs(epoch_us(w.timestamp) - epoch_us(f.timestamp)), w.timestamp)) AS external_temperature_f
FROM feeders f LEFT JOIN weather w ON abs(epoch_us(w.timestamp) - epoch_us(f.timestamp)) <= {reach}
GROUP BY ALL"""
WITHIN = NEAREST.format(reach="20 * 60000000")
oracle("asof_temperature", f"SELECT meter_id, timestamp, {r('external_temperature_f')} FROM ({WITHIN})", "feeders", "weather")
oracle("asof_temperature_unlimited", f"""
, before AS (SELECT meter_id, f.timestamp, w.timestamp AS at, w.temperature_f AS temp
             FROM feeders f ASOF LEFT JOIN weather w ON f.timestamp >= w.timestamp),
later AS (SELECT meter_id, f.timestamp, w.timestamp AS at, w.temperature_f AS temp
          FROM feeders f ASOF LEFT JOIN weather w ON f.timestamp <= w.timestamp)
SELECT meter_id, timestamp,
       {r('CASE WHEN b.at IS NULL OR l.at - timestamp < timestamp - b.at THEN l.temp ELSE b.temp END', 'external_temperature_f')}
FROM before b JOIN later l USING (meter_id, timestamp)""", "feeders", "weather")
ORACLES["asof_temperature_unlimited"] = ORACLES["asof_temperature_unlimited"].replace(")\n, before", "),\nbefore")
for key, pick in (
    ("merge_temperature", "coalesce(CASE WHEN demand_kw > 100 THEN 1.0 END, external_temperature_f)"),
    ("merge_temperature_override", "coalesce(external_temperature_f, CASE WHEN demand_kw > 100 THEN 1.0 END)"),
):
    oracle(key, f"SELECT meter_id, timestamp, {r('demand_kw')}, {r(pick, 'temperature_f')} FROM ({WITHIN})", "feeders", "weather")

oracle("resolve_groups", "SELECT * FROM resolved", "resolved")
oracle("portfolio_members", "SELECT * FROM portfolio", "portfolio")
oracle("entity_load", f"SELECT entity_id, timestamp, {r('demand_kw')}, n_meters_reporting FROM load", "load")
oracle("daily_profiles", f"""
SELECT entity_id, date, interval_index, minute_of_day, time_of_day, {r('demand_kw')}, is_complete_day FROM daily""", "daily")
oracle("normalized_profiles", f"""
SELECT entity_id, timestamp,
       {r('CASE WHEN peak > 0 THEN demand_kw / peak END', 'normalized_demand')}
FROM (SELECT *, max(demand_kw) OVER (PARTITION BY entity_id, date) AS peak FROM daily)""", "daily")
oracle("daily_features", f"""
SELECT entity_id, date, {r('mean_demand_kw')}, {r('maximum_demand_kw')}, {r('minimum_demand_kw')}, {r('daily_energy_kwh')},
       peak_minute, lpad(CAST(peak_minute // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(peak_minute % 60 AS VARCHAR), 2, '0') || ':00'
         AS peak_time,
       {r('load_factor')}, {r('peak_to_average_ratio')}, {r('standard_deviation_kw')}, {r('coefficient_of_variation')},
       is_complete_day
FROM features""", "features")
oracle("day_coverage", """
SELECT entity_id, CAST(timestamp AS DATE) AS date, min(n_meters_reporting) AS fewest_reporting,
       count(*) = 24 AND min(n_meters_reporting) = any_value(n_meters) AS is_fully_covered
FROM load JOIN (SELECT entity_id, count(DISTINCT meter_id) AS n_meters FROM joint GROUP BY 1
                UNION ALL SELECT 'm' || c_custkey, 1 FROM customer) USING (entity_id)
GROUP BY 1, 2""", "load")
SEGMENT_COLUMNS = (
    "morning_peak_kw", "midday_peak_kw", "afternoon_peak_kw", "evening_peak_kw", "overnight_mean_kw", "nighttime_mean_kw",
    "daytime_mean_kw",
)
oracle("segment_features", f"SELECT entity_id, date, {', '.join(map(r, SEGMENT_COLUMNS))} FROM segments", "segments")
oracle("daily_temperature", f"""
SELECT meter_id AS entity_id, CAST(timestamp AS DATE) AS date, {r('avg(temperature_f)', 'mean_temperature_f')},
       {r('max(temperature_f)', 'maximum_temperature_f')}, {r('min(temperature_f)', 'minimum_temperature_f')},
       {r('max(temperature_f) - min(temperature_f)', 'temperature_range_f')}
FROM obs GROUP BY 1, 2""", "obs")
oracle("entity_temperature", f"""
SELECT entity_id, CAST(timestamp AS DATE) AS date, {r('avg(temperature_f)', 'mean_temperature_f')},
       {r('max(temperature_f)', 'maximum_temperature_f')}, {r('min(temperature_f)', 'minimum_temperature_f')},
       {r('max(temperature_f) - min(temperature_f)', 'temperature_range_f')}
FROM obs JOIN (
    SELECT entity_id, meter_id
    FROM (SELECT * FROM joint UNION ALL SELECT 'm' || c_custkey, 'm' || c_custkey FROM customer)
    JOIN (SELECT meter_id, count(temperature_f) AS known FROM obs GROUP BY 1 HAVING known > 0) USING (meter_id)
    QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY known DESC, meter_id) = 1) USING (meter_id)
GROUP BY 1, 2""", "obs", "joint")
oracle("temperature_bands", f"""
SELECT meter_id, timestamp, {r('temperature_f')},
       CASE WHEN temperature_f <= {BANDS[0]} THEN 'below-32' WHEN temperature_f <= 50 THEN '32-50'
            WHEN temperature_f <= 65 THEN '50-65' WHEN temperature_f <= 80 THEN '65-80'
            WHEN temperature_f <= 90 THEN '80-90' WHEN temperature_f > 90 THEN '90-above' END AS temperature_band
FROM obs""", "obs")
oracle("weekday_daily_means", f"SELECT meter_id, date, {r('temperature_f')}, {r('demand_kw')} FROM points", "points")

oracle("cp_2p", f"""
SELECT meter_id, {r('base', 'base_kw')}, {r('slope', 'slope_kw_per_f')}, {r('r2', 'r_squared')}, s.n AS n_points,
       'change_point_regression_2p' AS method, l.n IS NOT NULL AS success
FROM sizes s LEFT JOIN line l USING (meter_id)""", "sizes", "line")
for key, kind, method in (
    ("cp_3p_cooling", "cooling", "change_point_regression"),
    ("cp_3p_heating", "heating", "change_point_regression_3p_heating"),
):
    oracle(key, f"""
SELECT meter_id, {r('base', 'base_kw')}, {r('slope', 'slope_kw_per_f')}, {r('p', 'breakpoint_f')}, {r('r2', 'r_squared')},
       s.n AS n_points, '{method}' AS method, b.p IS NOT NULL AS success
FROM sizes s LEFT JOIN (SELECT * FROM single_best WHERE kind = '{kind}') b USING (meter_id)""", "sizes", "single_best")
oracle("cp_4p", f"""
SELECT meter_id, {r('base', 'base_kw')}, {r('hs', 'heating_slope_kw_per_f')}, {r('cs', 'cooling_slope_kw_per_f')},
       {r('hp', 'breakpoint_f')}, {r('r2', 'r_squared')}, s.n AS n_points, 'change_point_regression_4p' AS method,
       b.hp IS NOT NULL AS success
FROM sizes s LEFT JOIN best_4p b USING (meter_id)""", "sizes", "best_4p")
oracle("cp_5p", f"""
SELECT meter_id, {r('base', 'base_kw')}, {r('hs', 'heating_slope_kw_per_f')}, {r('cs', 'cooling_slope_kw_per_f')},
       {r('hp', 'heating_breakpoint_f')}, {r('cp', 'cooling_breakpoint_f')}, {r('r2', 'r_squared')}, s.n AS n_points,
       'change_point_regression_5p' AS method, b.hp IS NOT NULL AS success
FROM sizes s LEFT JOIN best_5p b USING (meter_id)""", "sizes", "best_5p")
oracle("cp_select", f"""
SELECT meter_id, model, n_points, {r('r_squared')}, {r('adjusted_r_squared')}, success,
       adjusted_r_squared IS NOT NULL AND row_number() OVER (
         PARTITION BY meter_id ORDER BY round(adjusted_r_squared, 9) DESC NULLS LAST, p, listed) = 1 AS is_selected
FROM candidates""", "candidates")

oracle("class_threshold", """
SELECT entity_id, timestamp, coalesce(demand_kw >= 50, false) AS meets_threshold_50,
       coalesce(demand_kw >= 100, false) AS meets_threshold_100, coalesce(demand_kw >= 500, false) AS meets_threshold_500
FROM load""", "load")
oracle("class_percentile", """
SELECT entity_id, timestamp, coalesce(demand_kw >= q99, false) AS top_pct_99, coalesce(demand_kw >= q95, false) AS top_pct_95
FROM load LEFT JOIN (SELECT entity_id, quantile_cont(demand_kw, 0.99) AS q99, quantile_cont(demand_kw, 0.95) AS q95
                     FROM load GROUP BY 1) USING (entity_id)""", "load")
oracle("class_percentile_coarse", ORACLES["class_percentile"])
oracle("class_rank", """
SELECT entity_id, timestamp, place <= 10 AS top_rank_10, place <= 25 AS top_rank_25, place <= 50 AS top_rank_50
FROM (SELECT *, CASE WHEN demand_kw IS NULL THEN 1000000000
                ELSE row_number() OVER (PARTITION BY entity_id ORDER BY demand_kw DESC NULLS LAST, timestamp) END AS place
      FROM load)""", "load")
oracle("ramps", f"""
SELECT entity_id, timestamp, {r('ramp', 'ramp_kw')}, {r('CASE WHEN ramp > 0 THEN ramp WHEN ramp <= 0 THEN 0 END', 'ramp_up_kw')},
       {r('CASE WHEN ramp < 0 THEN -ramp WHEN ramp >= 0 THEN 0 END', 'ramp_down_kw')}
FROM (SELECT *, demand_kw - lag(demand_kw) OVER (PARTITION BY entity_id ORDER BY timestamp) AS ramp FROM load)""", "load")
oracle("local_extrema", "SELECT * FROM extrema", "extrema")
oracle("peak_events", f"""
SELECT event_id, entity_id, peak_definition, start_time, end_time, {r('duration_hours')}, {r('maximum_demand_kw')},
       {r('mean_demand_kw')}, {r('minimum_demand_kw')}, n_intervals FROM events_found""", "events_found")
oracle("event_duration_class", f"""
SELECT event_id, {r('duration_hours')}, CASE WHEN duration_hours >= 2 THEN 'sustained' ELSE 'short' END AS duration_class
FROM events_found""", "events_found")
oracle("day_shape_flags", "SELECT * FROM shape_flags", "shape_flags")
oracle("day_shape_primary", "SELECT entity_id, date, primary_shape FROM shapes", "shapes")

def listed(expression: str, name: str) -> str:
    """The text form of a list of doubles in checks.queries.settled."""
    return (
        f"array_to_string(list_transform({expression}, lambda v: CAST(round((v + {OFF_EDGE:.8f}) * 1000000) AS BIGINT)), ',')"
        f" AS {name}"
    )


oracle("day_vectors", f"SELECT entity_id, kind, date, {listed('vector', 'vector')} FROM vectors", "vectors")
SUMMARY = """
SELECT entity_id, kind, cluster_id, cluster_size, {share}, {peak}, {spread}, {centroid}
FROM (SELECT entity_id, kind, cluster_id, max(size) AS cluster_size, max(mean) AS peak, avg(sd) AS spread,
             list(mean ORDER BY slot) AS centroid
      FROM (SELECT entity_id, kind, cluster_id, slot, count(*) AS size, avg(vector[slot]) AS mean, stddev_pop(vector[slot]) AS sd
            FROM ({labelled}) CROSS JOIN (SELECT unnest(range(1, 25)) AS slot) GROUP BY ALL)
      GROUP BY ALL)"""
SUMMARY_COLUMNS = {
    "share": r(
        "round_even(100 * cluster_size / sum(cluster_size) OVER (PARTITION BY entity_id, kind), 1)", "percentage_of_days"
    ),
    "peak": r("peak", "representative_peak"),
    "spread": r("spread", "within_cluster_variability"),
    "centroid": listed("centroid", "centroid"),
}
oracle("cluster_single", SUMMARY.format(labelled="""
    SELECT *, 0 AS cluster_id FROM vectors
    QUALIFY count(*) OVER (PARTITION BY entity_id, kind) > 1""", **SUMMARY_COLUMNS), "vectors")
oracle("cluster_summary", SUMMARY.format(labelled="""
    SELECT v.*, CASE WHEN peak_minute < 720 THEN 0 ELSE 1 END AS cluster_id
    FROM vectors v JOIN features f ON v.entity_id = f.entity_id AND v.date = f.date""", **SUMMARY_COLUMNS),
       "vectors", "features")

DAYS_APART = """
    SELECT entity_id, kind, date, list_transform(vector, lambda v: v + 100 * raised) AS vector, n,
           CASE WHEN n % 2 = 1 THEN raised ELSE 1 - raised END AS label
    FROM (SELECT *, (row_number() OVER (PARTITION BY entity_id, kind ORDER BY date) + 1) % 2 AS raised,
                 count(*) OVER (PARTITION BY entity_id, kind) AS n
          FROM vectors WHERE kind = 'normalized')"""
BEFORE_NOON = """
    SELECT v.*, CASE WHEN peak_minute < 720 THEN 0 ELSE 1 END AS label
    FROM vectors v JOIN features f ON v.entity_id = f.entity_id AND v.date = f.date"""
SILHOUETTE = """
    SELECT entity_id, kind, avg(CASE WHEN b IS NULL THEN NULL WHEN a IS NULL OR greatest(a, b) = 0 THEN 0
                                     ELSE (b - a) / greatest(a, b) END) AS silhouette
    FROM (SELECT entity_id, kind, date, max(CASE WHEN label = other AND size > 1 THEN total / (size - 1) END) AS a,
                 min(CASE WHEN label <> other THEN total / size END) AS b
          FROM (SELECT x.entity_id, x.kind, x.date, x.label, y.label AS other, count(*) AS size,
                       sum(list_distance(CAST(x.vector AS DOUBLE[]), CAST(y.vector AS DOUBLE[]))) AS total
                FROM ({labelled}) x JOIN ({labelled}) y ON x.entity_id = y.entity_id AND x.kind = y.kind
                GROUP BY ALL)
          GROUP BY ALL)
    GROUP BY ALL"""
for blocks in ("", "_blocks"):
    oracle(f"cluster_days_apart{blocks}", f"""
SELECT entity_id, kind, date, CASE WHEN n > 1 THEN CAST(label AS INTEGER) END AS cluster_id,
       CASE WHEN n > 1 THEN 2 END AS n_clusters, {r("CASE WHEN n > 1 THEN silhouette END", "silhouette")}
FROM ({DAYS_APART}) JOIN ({SILHOUETTE.format(labelled=DAYS_APART)}) USING (entity_id, kind)""", "vectors")
    oracle(f"cluster_auto_k_apart{blocks}", f"""
SELECT DISTINCT entity_id, kind, CASE WHEN n > 3 THEN 2 WHEN n > 1 THEN 1 END AS n_clusters,
       {r("CASE WHEN n > 3 THEN silhouette END", "silhouette")}, n AS n_days, n > 1 AS success
FROM ({DAYS_APART}) JOIN ({SILHOUETTE.format(labelled=DAYS_APART)}) USING (entity_id, kind)""", "vectors")
oracle("silhouette_given_labels", f"""
SELECT entity_id, kind, {r("silhouette")} FROM ({SILHOUETTE.format(labelled=BEFORE_NOON)})""", "vectors", "features")

FAR_APART = """
    SELECT entity_id, kind, date, list_transform(vector, lambda v: v + 4 * largest * raised) AS vector, n,
           CASE WHEN 2 * sum(raised) OVER (PARTITION BY kind) >= n THEN 1 - raised ELSE raised END AS label
    FROM (SELECT *, (row_number() OVER (PARTITION BY entity_id, kind ORDER BY date) + 1) % 2 AS raised,
                 count(*) OVER (PARTITION BY kind) AS n, max(list_max(vector)) OVER (PARTITION BY kind) AS largest
          FROM vectors)"""
POOLED = """
    SELECT kind, avg(CASE WHEN b IS NULL THEN NULL WHEN a IS NULL OR greatest(a, b) = 0 THEN 0
                          ELSE (b - a) / greatest(a, b) END) AS silhouette
    FROM (SELECT entity_id, kind, date, max(CASE WHEN label = other AND size > 1 THEN total / (size - 1) END) AS a,
                 min(CASE WHEN label <> other THEN total / size END) AS b
          FROM (SELECT x.entity_id, x.kind, x.date, x.label, y.label AS other, count(*) AS size,
                       sum(list_distance(CAST(x.vector AS DOUBLE[]), CAST(y.vector AS DOUBLE[])) ^ 2) AS total
                FROM ({labelled}) x JOIN ({labelled}) y ON x.kind = y.kind
                GROUP BY ALL)
          GROUP BY ALL)
    GROUP BY ALL"""
oracle("cluster_days_pooled", f"""
SELECT entity_id, kind, date, CASE WHEN n > 1 THEN CAST(label AS INTEGER) END AS cluster_id,
       CASE WHEN n > 1 THEN 2 END AS n_clusters, {r("CASE WHEN n > 1 THEN silhouette END", "silhouette")}
FROM ({FAR_APART}) JOIN ({POOLED.format(labelled=FAR_APART)}) USING (kind)""", "vectors")
oracle("cluster_auto_k_pooled", f"""
SELECT DISTINCT kind, CASE WHEN n > 3 THEN 2 WHEN n > 1 THEN 1 END AS n_clusters,
       {r("CASE WHEN n > 3 THEN silhouette END", "silhouette")}, CASE WHEN n > 1 THEN n ELSE 0 END AS n_days, n > 1 AS success
FROM ({FAR_APART}) JOIN ({POOLED.format(labelled=FAR_APART)}) USING (kind)""", "vectors")
oracle("silhouette_pooled", f"""
SELECT kind, {r("silhouette")} FROM ({POOLED.format(labelled=BEFORE_NOON)})""", "vectors", "features")

HHMM = "lpad(CAST(bucket // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(bucket % 60 AS VARCHAR), 2, '0')"
TIMING = f"""
SELECT entity_id, entity_id || '_peak_timing_' || lpad(CAST(number AS VARCHAR), 3, '0') AS pattern_id,
       'recurring_peak_timing' AS pattern_type,
       'Daily peak recurs near ' || {HHMM} || ' on ' || frequency || ' of ' || n_days || ' complete days' AS description,
       frequency, dates, {HHMM} AS representative_peak_time,
       {r('round_even(frequency / n_days, 3)', 'statistical_support')}
FROM timing WHERE frequency >= 3"""
oracle("recurring_peak_timing", TIMING, "timing")
SHAPE_PATTERNS = f"""
SELECT entity_id, entity_id || '_shape_' || lpad(CAST(number AS VARCHAR), 3, '0') AS pattern_id,
       'recurring_shape' AS pattern_type,
       '''' || primary_shape || ''' shape recurs on ' || frequency || ' of ' || n_days || ' days' AS description,
       frequency, dates, primary_shape AS shape,
       {r('round_even(frequency / n_days, 3)', 'statistical_support')}
FROM shape_groups WHERE frequency >= 3 AND primary_shape <> 'insufficient_data'"""
oracle("recurring_shapes", SHAPE_PATTERNS, "shape_groups")
oracle("outlier_days", f"""
SELECT entity_id, entity_id || '_outlier_' || lpad(CAST(number AS VARCHAR), 3, '0') AS pattern_id, 'outlier_day' AS pattern_type,
       date || ' is an outlier on ' || metric || ' (z=' || printf('%.2f', z) || ')' AS description, date, metric,
       {r('value')}, {r('round_even(z, 3)', 'z_score')}, 'z >= 2.5' AS statistical_support
FROM outliers""", "outliers")
oracle("peak_contribution", f"""
SELECT entity_id, timestamp, {r('aggregate_demand_kw')}, meter_id, {r('analysis_demand_kw', 'meter_demand_kw')},
       {r('analysis_demand_kw / nullif(aggregate_demand_kw, 0) * 100', 'pct_contribution')}
FROM (SELECT * FROM joint_load
      QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY aggregate_demand_kw DESC NULLS LAST, timestamp) <= 10)
JOIN joint USING (entity_id) JOIN obs USING (meter_id, timestamp)""", "joint_load")
oracle("interval_coincidence", f"""
SELECT entity_id, meter_id, coalesce(near_count, 0) AS n_near_peak_intervals, coalesce(shared_count, 0) AS n_coincident_with_any_other,
       {r('round_even(shared_count / near_count, 3)', 'coincidence_rate')}
FROM joint LEFT JOIN (
  SELECT entity_id, meter_id, count(*) AS near_count, count_if(together > 1) AS shared_count
  FROM (SELECT entity_id, meter_id, count(*) OVER (PARTITION BY entity_id, timestamp) AS together
        FROM near JOIN joint USING (meter_id)) GROUP BY ALL) USING (entity_id, meter_id)""", "near", "joint")
oracle("diversity_factor", f"""
SELECT entity_id, {r('own', 'sum_of_individual_peaks_kw')}, {r('joined', 'aggregate_peak_kw')},
       {r('CASE WHEN joined > 0 THEN own / joined END', 'diversity_factor')}
FROM (SELECT entity_id, sum(peak) AS own FROM joint JOIN (SELECT meter_id, max(analysis_demand_kw) AS peak FROM obs GROUP BY 1)
      USING (meter_id) GROUP BY 1)
JOIN (SELECT entity_id, max(aggregate_demand_kw) AS joined FROM joint_load GROUP BY 1) USING (entity_id)""", "joint_load")
oracle("stage_summary", f"""
SELECT 'days' AS section, entity_id, CASE WHEN is_complete_day THEN 'complete' ELSE 'incomplete' END AS label, count(*) AS n
FROM features GROUP BY ALL
UNION ALL SELECT 'quality', NULL, data_quality_flag, count(*) FROM obs GROUP BY ALL
UNION ALL SELECT 'peak_events', entity_id, peak_definition, count(*) FROM events_found GROUP BY ALL
UNION ALL SELECT 'primary_shape', entity_id, primary_shape, count(*) FROM shapes GROUP BY ALL
UNION ALL SELECT 'patterns', entity_id, pattern_type, count(*) FROM ({TIMING}) GROUP BY ALL
UNION ALL SELECT 'patterns', entity_id, pattern_type, count(*) FROM ({SHAPE_PATTERNS}) GROUP BY ALL
UNION ALL SELECT 'patterns', entity_id, 'outlier_day', count(*) FROM outliers GROUP BY ALL""",
       "features", "obs", "events_found", "shapes", "timing", "shape_groups", "outliers")
