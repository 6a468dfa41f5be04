from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2025, 1, 1)


def series(spark, values, key="entity_id", name="X", minutes=60, start=START, column="demand_kw"):
    """One series on a grid; None is a row with a missing value."""
    rows = [(name, start + timedelta(minutes=minutes * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"{key} string, timestamp timestamp_ntz, {column} double")


def readings(spark, values, name="M", minutes=60, start=START):
    """As series, but None is an absent row."""
    rows = [(name, start + timedelta(minutes=minutes * i), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "meter_id string, timestamp timestamp_ntz, demand_kw double")


def column(df, name, *order):
    return [row[name] for row in df.orderBy(*(order or ("timestamp",))).collect()]
