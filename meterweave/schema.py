"""Column names, types and fixed values shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED_COLUMNS = ("timestamp", "meter_id", "demand_kw")
OPTIONAL_COLUMNS = ("temperature_f",)

# Readings arrive as text so that a bad value becomes a countable NULL.
RAW_READINGS = T.StructType(
    [T.StructField(c, T.StringType()) for c in REQUIRED_COLUMNS + OPTIONAL_COLUMNS]
)

# Quality flags, severities, entity types.
OBSERVED, INTERPOLATED, MISSING = "observed", "interpolated", "missing"
INFO, WARNING, ERROR = "INFO", "WARNING", "ERROR"
METER, GROUP, PORTFOLIO = "meter", "group", "portfolio"
PORTFOLIO_ID = "Portfolio"
TOTAL_ROW_ID = "PORTFOLIO"

# Month -> season.
SEASON_BY_MONTH = {
    1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring", 6: "summer",
    7: "summer", 8: "summer", 9: "fall", 10: "fall", 11: "fall", 12: "winter",
}

# Time-of-day segments in hours, start inclusive, end exclusive.
SEGMENTS = {"morning": (6, 10), "midday": (10, 14), "afternoon": (14, 18), "evening": (18, 22)}
DAYTIME = (6, 22)

# Texts a CSV reader takes for a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
