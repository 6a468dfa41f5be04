"""Calendar columns and interval energy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from meterweave import schema


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def calendar_features(
    rows: DataFrame,
    holidays: Sequence[str] = (),
    season_by_month: Mapping[int, str] | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Add date parts, weekday flags, season and day type.

    is_weekday ignores holidays; day_type puts holidays before weekday and weekend.
    """
    stamp, day = F.col(ts), F.to_date(ts)
    seasons = F.create_map(
        *[F.lit(x) for pair in (season_by_month or schema.SEASON_BY_MONTH).items() for x in pair]
    )
    day_type = F.when(is_weekday(day), "weekday").otherwise("weekend")
    if holidays:
        named = [F.lit(h).cast("date") for h in holidays]
        day_type = F.when(day.isin(*named), "holiday").otherwise(day_type)
    return rows.withColumns(
        {
            "date": day,
            "year": F.year(stamp),
            "month": F.month(stamp),
            "day": F.day(stamp),
            "day_of_year": F.dayofyear(stamp),
            "hour": F.hour(stamp),
            "minute": F.minute(stamp),
            "day_of_week": F.weekday(stamp),
            "day_name": F.date_format(stamp, "EEEE"),
            "is_weekday": is_weekday(day),
            "is_weekend": ~is_weekday(day),
            "season": F.try_element_at(seasons, F.month(stamp)),
            "day_type": F.when(stamp.isNotNull(), day_type),
        }
    )


def interval_energy(
    rows: DataFrame, interval_minutes: int, demand: str = "analysis_demand_kw"
) -> DataFrame:
    """Add energy_kwh = kW * minutes / 60; missing demand stays missing."""
    return rows.withColumn("energy_kwh", F.col(demand) * interval_minutes / 60)
