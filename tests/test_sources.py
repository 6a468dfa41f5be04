import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterweave.operators import validation
from meterweave.sources import readings as sources, sinks


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_is_text_with_missing_tokens_as_null(spark, tmp_path):
    path = write(tmp_path / "r.csv", "when,id,load,site\n2025-01-01 00:15:00,B1,1.5,x\n2025-01-01 00:30:00,B1,N/A,y\nbad,B1,oops,z\n")
    raw = sources.read_readings(spark, path)
    assert raw.columns == ["when", "id", "load", "site"]
    rows = sources.canonicalize(raw, {"timestamp": "when", "meter_id": "id", "demand_kw": "load"}, "yyyy-MM-dd HH:mm:ss")
    got = [(r.timestamp, r.demand_kw, r.site) for r in rows.collect()]
    assert got == [(datetime(2025, 1, 1, 0, 15), 1.5, "x"), (datetime(2025, 1, 1, 0, 30), None, "y"), (None, None, "z")]


def test_other_formats_are_refused(spark):
    with pytest.raises(NotImplementedError):
        sources.read_readings(spark, "x", "xlsx")


def test_weather(spark, tmp_path):
    assert sources.read_weather(spark, "") is None
    path = write(tmp_path / "w.csv", "DATE,TEMP\n01/01/25 00:00,30\n,31\n01/01/25 01:00,M\n")
    got = sources.read_weather(spark, path, {"timestamp": "DATE", "temperature_f": "TEMP"}, "MM/dd/yy HH:mm")
    assert [tuple(r) for r in got.orderBy("timestamp").collect()] == [
        (datetime(2025, 1, 1, 0), 30.0), (datetime(2025, 1, 1, 1), None),
    ]
    with pytest.raises(ValueError, match="temperature_f"):
        sources.read_weather(spark, path, {"timestamp": "DATE"})


def findings(rows, **options):
    return {r.message.split(" ", 1)[1][:9]: (r.severity, r.n) for r in validation.validate_readings(rows, **options).collect()}


def test_findings_and_gate(spark):
    data = [
        ("2025-01-01 00:00:00", "A", "1"), ("2025-01-01 00:00:00", "A", "2"), ("nope", "A", "3"),
        ("2025-01-01 01:00:00", None, "-4"), ("2025-01-01 02:00:00", "A", "x"), ("2025-01-01 03:00:00", "A", None),
    ]
    rows = spark.createDataFrame(data, "timestamp string, meter_id string, demand_kw string")
    got = findings(rows, severities={"negative_demand": "warning"})
    assert got == {
        "timestamp": ("ERROR", 1), "demand_kw": ("ERROR", 1), "negative ": ("WARNING", 1),
        "row(s) mi": ("ERROR", 1), "duplicate": ("ERROR", 1),
    }
    only_double = validation.validate_readings(rows.limit(2))
    validation.raise_if_fatal(only_double)
    with pytest.raises(validation.ValidationError):
        validation.raise_if_fatal(validation.validate_readings(rows))
    negative = validation.validate_readings(rows.where("demand_kw = '-4' or demand_kw = '1'").na.fill("B", ["meter_id"]), {"negative_demand": "warning"})
    validation.raise_if_fatal(negative)
    with pytest.raises(validation.ValidationError):
        validation.raise_if_fatal(negative, strict=True)


def test_missing_required_column_stops_the_check(spark):
    rows = spark.createDataFrame([("A", "1")], "meter_id string, demand_kw string")
    got = validation.validate_readings(rows).collect()
    assert [(r.severity, r.n) for r in got] == [("ERROR", 1)] and "timestamp" in got[0].message


def test_dedupe_keeps_the_first_by_ordinal_or_the_lowest_value(spark):
    rows = spark.createDataFrame(
        [("A", 1, 7.0, 2), ("A", 1, 9.0, 1), ("A", 2, None, 3), ("A", 2, 5.0, 4)],
        "meter_id string, t int, demand_kw double, line int",
    ).selectExpr("meter_id", "timestamp_ntz'2025-01-01' + make_interval(0,0,0,0,t) AS timestamp", "demand_kw", "line")
    first = validation.dedupe_readings(rows, "line").orderBy("timestamp").collect()
    assert [r.demand_kw for r in first] == [9.0, None]
    lowest = validation.dedupe_readings(rows).orderBy("timestamp").collect()
    assert [r.demand_kw for r in lowest] == [7.0, 5.0]


@pytest.mark.parametrize("per_entity, file_format", [(False, "parquet"), (True, "csv")])
def test_outputs_read_back(spark, tmp_path, per_entity, file_format):
    rows = spark.sql("SELECT * FROM VALUES ('A', date'2025-01-01', 1.5, array(date'2025-01-01')), ('B', date'2025-01-02', 2.5, array()) AS t(entity_id, date, kw, dates)")
    path = sinks.write_outputs({"days": rows}, str(tmp_path), file_format, per_entity)["days"]
    back = spark.read.option("header", True).format(file_format).load(path)
    assert sorted((r.entity_id, float(r.kw)) for r in back.collect()) == [("A", 1.5), ("B", 2.5)]
    if per_entity:
        assert {p.name for p in (tmp_path / "days").iterdir() if p.is_dir()} == {"entity_id=A", "entity_id=B"}


def test_type_letters_are_no_numbers_and_patterns_are_tried_in_order(spark):
    from pyspark.sql import functions as F

    from meterweave.operators.validation import dedupe_readings
    from meterweave.sources.readings import as_number, as_timestamp

    texts = spark.createDataFrame([("12d",), ("1.5F",), ("7",), ("1e3",), ("Infinity",), ("inf",), ("x",)], "t string")
    assert [r[0] for r in texts.select(as_number("t")).collect()] == [None, None, 7.0, 1000.0, math.inf, math.inf, None]
    stamps = spark.createDataFrame([("6/1/2025 0:15",), ("2025-06-01 00:30",), ("?",)], "t string")
    parsed = as_timestamp("t", stamps.schema["t"].dataType, ["M/d/yyyy H:mm", "yyyy-MM-dd HH:mm"])
    assert [r[0] for r in stamps.select(parsed.cast("string")).collect()] == ["2025-06-01 00:15:00", "2025-06-01 00:30:00", None]
    rows = spark.createDataFrame([("m", 1, 5.0, None, 1), ("m", 1, 7.0, 60.0, 1), ("m", 1, 1.0, 50.0, None)], "meter_id string, t int, demand_kw double, temperature_f double, n int")
    kept = dedupe_readings(rows.withColumn("timestamp", F.lit("2025-06-01").cast("timestamp_ntz")).drop("t"), "n").first()
    assert (kept["demand_kw"], kept["temperature_f"]) == (5.0, None)


def test_the_pattern_of_each_file_is_found(spark):
    written = [("a", "6/1/2025 0:15"), ("a", "6/13/2025 0:30"), ("a", None), ("b", "1.6.2025 0:15"), ("b", "garbled"), ("c", "3/4/2025 1:00"), ("d", None), ("e", "5/5/2025 1:00")]
    raw = spark.createDataFrame([(f, t, "m", "1") for f, t in written], "path string, timestamp string, meter_id string, demand_kw string")
    found = {r.file: r for r in sources.timestamp_patterns(raw, F.col("path")).collect()}
    assert {f: (r.pattern, r.n_given, r.n_parsed) for f, r in found.items()} == {
        "a": ("M/d/yyyy H:mm[:ss]", 2, 2), "b": ("d.M.yyyy H:mm[:ss]", 2, 1), "c": ("M/d/yyyy H:mm[:ss]", 1, 1),
        "d": (None, 0, 0), "e": ("M/d/yyyy H:mm[:ss]", 1, 1),
    }
    # The fifth of May is the same either way; the third of April is not.
    assert {f for f, r in found.items() if r.ambiguous_with} == {"c"} and found["c"].ambiguous_with == ["d/M/yyyy H:mm[:ss]"]
    findings = sources.ambiguous_findings(sources.timestamp_patterns(raw, F.col("path"))).collect()
    assert [(r.severity, r.n) for r in findings] == [("WARNING", 1)]
    rows = sources.canonicalize(raw, pattern="auto", file=F.col("path"))
    assert rows.columns == raw.columns
    stamps = sorted(str(r.timestamp) for r in rows.collect())
    assert stamps == ["2025-03-04 01:00:00", "2025-05-05 01:00:00", "2025-06-01 00:15:00", "2025-06-01 00:15:00", "2025-06-13 00:30:00", "None", "None", "None"]
    assert sources.canonicalize(raw.where("path = 'b'"), pattern="auto").where("timestamp is not null").count() == 1
    assert sources.timestamp_patterns(raw.limit(0)).isEmpty()


def test_a_run_for_some_entities_leaves_the_others(spark, tmp_path):
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "entity_id string, v int")
    path = sinks.write_outputs({"t": table}, str(tmp_path), "csv", per_entity=True)["t"]
    kept = sorted((tmp_path / "t" / "entity_id=a").glob("*.csv"))
    changed = spark.createDataFrame([("b", 4), ("c", 5)], "entity_id string, v int")
    for _ in range(2):
        sinks.write_outputs({"t": changed}, str(tmp_path), "csv", per_entity=True)
        got = sorted((r.entity_id, r.v) for r in spark.read.schema("v int, entity_id string").option("header", True).csv(path).collect())
        assert got == [("a", 1), ("a", 2), ("b", 4), ("c", 5)]
    assert sorted((tmp_path / "t" / "entity_id=a").glob("*.csv")) == kept
