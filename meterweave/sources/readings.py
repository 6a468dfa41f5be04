"""Reading and weather sources, and the mapping to canonical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from meterweave import schema

FORMATS = ("csv", "parquet")
#: Patterns that time texts are tried with, the likelier first.
PATTERNS = [
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "M/d/yyyy H:mm[:ss]", "d/M/yyyy H:mm[:ss]",
    "M/d/yy H:mm", "d/M/yy H:mm", "d.M.yyyy H:mm[:ss]", "yyyy/M/d H:mm[:ss]", "yyyyMMddHHmm",
]


def read_readings(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "csv",
    columns: T.StructType | None = None,
) -> DataFrame:
    """The reading file as it is, source column names unchanged.

    CSV columns are read as text, unless a schema is given, so that bad values
    can be counted; the usual texts for a missing value become NULL.
    """
    if file_format not in FORMATS:
        raise NotImplementedError(f"file format {file_format!r} is not supported")
    if file_format == "parquet":
        reader = spark.read.schema(columns) if columns is not None else spark.read
        return reader.parquet(*([path] if isinstance(path, str) else path))
    reader = spark.read.option("header", True).option("enforceSchema", False)
    rows = (reader.schema(columns) if columns is not None else reader).csv(path)
    return rows.select(
        *[
            F.when(~F.col(f.name).isin(*schema.MISSING_TOKENS), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in rows.schema
        ]
    )


def map_columns(raw: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename source columns to canonical ones (canonical -> source); other columns stay."""
    return raw.withColumnsRenamed({source: canonical for canonical, source in mapping.items()})


def as_number(c: str) -> Column:
    """Double, with NULL for texts that are no number and for NaN.

    A cast alone would read the type letter of a literal: 12d as 12, 1.5f as 1.5.
    """
    number = F.col(c).try_cast("double")
    return F.when(~F.isnan(number) & ~F.col(c).cast("string").rlike(r"[0-9.]\s*[dDfF]\s*$"), number)


def as_timestamp(c: str, dtype: T.DataType, pattern: str | list[str] | None = None) -> Column:
    """Naive timestamp, with NULL for texts that do not parse; several patterns are tried in their order."""
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.col(c).cast("timestamp_ntz")
    if pattern:
        tried = [F.try_to_timestamp(F.col(c).cast("string"), F.lit(p)) for p in ([pattern] if isinstance(pattern, str) else pattern)]
        return F.coalesce(*tried).cast("timestamp_ntz")
    return F.col(c).try_cast("timestamp_ntz")


def _parsed(c: Column, pattern: str) -> Column:
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def timestamp_patterns(rows: DataFrame, file: Column | None = None, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    """(file, pattern, n_given, n_parsed, ambiguous_with): how each file writes its time texts.

    The pattern that reads most texts of a file wins, the earlier in the list on a
    tie. ambiguous_with has the others that read as many, but as other times.
    pattern is NULL where none reads any. All counts come from one aggregate over
    the rows; file is any column that tells sources apart, by default all rows
    are of one.
    """
    text = F.col("timestamp").cast("string")
    tried = rows.select((F.lit("") if file is None else file).alias("file"), text.alias("text"))
    # The sum of a reading's seconds tells it from another one with as many.
    votes = F.array(
        *[
            F.struct(F.count(_parsed(F.col("text"), p)).alias("n"), F.sum(F.unix_seconds(_parsed(F.col("text"), p).cast("timestamp"))).alias("at"))
            for p in patterns
        ]
    )
    counted = tried.groupBy("file").agg(F.count("text").alias("n_given"), votes.alias("votes"))
    most = F.array_max(F.transform("votes", lambda v: v["n"]))
    names = F.array(*[F.lit(p) for p in patterns])
    winner = counted.withColumn("n_parsed", most).withColumn("i", F.array_position(F.transform("votes", lambda v: v["n"]), F.col("n_parsed")).cast("int"))
    rivals = F.filter(names, lambda name, i: (F.get("votes", i)["n"] == F.col("n_parsed")) & (F.get("votes", i)["at"] != F.get("votes", F.col("i") - 1)["at"]))
    read = F.col("n_parsed") > 0
    return winner.select(
        "file", F.when(read, F.get(names, F.col("i") - 1)).alias("pattern"), "n_given", "n_parsed",
        F.when(read, rivals).otherwise(F.array().cast("array<string>")).alias("ambiguous_with"),
    )


def ambiguous_findings(found: DataFrame) -> DataFrame:
    """Findings (severity, message, section, n) on files whose times can be read in several ways; n is their texts."""
    message = F.format_string("timestamps of '%s' read as %s could also be %s", "file", "pattern", F.array_join("ambiguous_with", ", "))
    return found.where(F.size("ambiguous_with") > 0).select(
        F.lit(schema.WARNING).alias("severity"), message.alias("message"), F.lit("ingestion").alias("section"), F.col("n_parsed").alias("n")
    )


def with_found_timestamps(rows: DataFrame, file: Column | None = None, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    """Time texts read by the pattern found for their file; a handful of rows per file is joined to all."""
    named = rows.withColumn("_file", F.lit("") if file is None else file)
    found = timestamp_patterns(named, F.col("_file"), patterns).select(F.col("file").alias("_file"), F.col("pattern").alias("_pattern"))
    joined = named.join(found, named["_file"].eqNullSafe(found["_file"]), "left").drop(found["_file"])
    stamp = F.coalesce(*[F.when(F.col("_pattern") == p, _parsed(F.col("timestamp").cast("string"), p)) for p in patterns])
    return joined.withColumn("timestamp", stamp).select(*rows.columns)


def canonicalize(
    raw: DataFrame, mapping: dict[str, str] | None = None, pattern: str | list[str] | None = None, file: Column | None = None
) -> DataFrame:
    """Canonical names and types: naive timestamp, text meter id, double demand and temperature.

    The pattern "auto" is found from the data, for each value of file by itself.
    """
    rows = map_columns(raw, mapping or {})
    if pattern == "auto":
        rows, pattern = with_found_timestamps(rows, file) if isinstance(rows.schema["timestamp"].dataType, T.StringType) else rows, None
    types = {f.name: f.dataType for f in rows.schema}
    typed = {
        "timestamp": as_timestamp("timestamp", types["timestamp"], pattern),
        "meter_id": F.col("meter_id").cast("string"),
        "demand_kw": as_number("demand_kw"),
    }
    if "temperature_f" in types:
        typed["temperature_f"] = as_number("temperature_f")
    return rows.withColumns(typed)


def read_weather(
    spark: SparkSession,
    path: str | None,
    mapping: dict[str, str] | None = None,
    pattern: str | None = None,
    file_format: str = "csv",
) -> DataFrame | None:
    """Site temperature (timestamp, temperature_f), or None if no file is configured."""
    if not path:
        return None
    return weather_table(read_readings(spark, path, file_format), mapping, pattern)


def weather_table(
    raw: DataFrame, mapping: dict[str, str] | None = None, pattern: str | None = None
) -> DataFrame:
    rows = map_columns(raw, mapping or {})
    for required in ("timestamp", "temperature_f"):
        if required not in rows.columns:
            raise ValueError(f"weather table has no column {required!r} after mapping")
    stamp = as_timestamp("timestamp", rows.schema["timestamp"].dataType, pattern)
    return rows.select(
        stamp.alias("timestamp"), as_number("temperature_f").alias("temperature_f")
    ).where(F.col("timestamp").isNotNull())
