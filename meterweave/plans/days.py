"""Work on a long series day by day.

A window over a whole series puts the series into one task. Everything that
looks along a series is therefore planned in two levels: windows inside one
(series, date), whose rows are bounded by the sampling interval, and windows
over one summary row per (series, date), whose rows are bounded by the calendar.
The summary is joined back on (series, date), the key both sides are already
partitioned by, so a hot series is spread over its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from meterweave.session import partitions


def per_series(keys: list[str], descending: bool = False) -> WindowSpec:
    """All earlier (or, descending, all later) days of a series.

    A descending order keeps the frame a growing one: a frame that ends in
    UNBOUNDED FOLLOWING is evaluated again for every row.
    """
    order = F.desc("date") if descending else F.asc("date")
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def adjacent_days(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("date")


def in_day(keys: list[str], order: str = "timestamp", descending: bool = False) -> WindowSpec:
    ordered = F.desc(order) if descending else F.asc(order)
    return Window.partitionBy(*keys, "date").orderBy(ordered)


def whole_day(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys, "date")


def with_date(rows: DataFrame, ts: str = "timestamp") -> DataFrame:
    return rows if "date" in rows.columns else rows.withColumn("date", F.to_date(ts))


def placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that have a key and a day.

    Stated as IS NOT NULL per column: the join with the day summary then infers
    nothing new, both of its inputs stay the same plan, and the shuffle is reused.
    """
    rows = with_date(rows)
    for c in [*keys, "date"]:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def by_day(rows: DataFrame, keys: list[str], to_expand: bool = False) -> DataFrame:
    """Lay rows out by (series, date), the layout all day-wise operators work on.

    Spark merges small partitions afterwards. Where days are still `to_expand`
    into intervals their bytes say little about the work to come, and the
    session's number of partitions is kept.
    """
    rows = placed(rows, keys)
    if not to_expand:
        return rows.repartition(*keys, "date")
    return rows.repartition(partitions(rows.sparkSession), *keys, "date")


def join_day_state(rows: DataFrame, keys: list[str], days: DataFrame) -> DataFrame:
    return rows.join(days, [*keys, "date"], "left")


def join_facts(rows: DataFrame, keys: list[str], facts: DataFrame, how: str = "left") -> DataFrame:
    """Join facts of a series (by `keys`) to its rows without gathering the series.

    The facts go to the days of the series first, one row each, and from there
    to the rows by (series, date), the layout the rows have. A join on the
    series alone would shuffle all rows and put a hot series into one place.
    """
    days = rows.select(*keys, "date").distinct().join(facts, keys)
    return rows.join(days, [*keys, "date"], how)


def with_neighbours(
    rows: DataFrame,
    keys: list[str],
    value: str,
    names: tuple[str, str],
    order: str = "timestamp",
) -> DataFrame:
    """Add the value of the previous and of the next row of the series."""
    previous, following = names
    rows = placed(rows, keys)
    days = rows.groupBy(*keys, "date").agg(
        F.min_by(value, order).alias("_first"), F.max_by(value, order).alias("_last")
    )
    along = adjacent_days(keys)
    days = days.select(
        *keys, "date", F.lag("_last").over(along).alias("_day_before"),
        F.lead("_first").over(along).alias("_day_after"),
    )
    inside = in_day(keys, order)
    near = rows.select(
        "*",
        F.lag(value).over(inside).alias("_lag"),
        F.lag(order).over(inside).isNull().alias("_opens"),
        F.lead(value).over(inside).alias("_lead"),
        F.lead(order).over(inside).isNull().alias("_closes"),
    )
    return (
        join_day_state(near, keys, days)
        .withColumn(previous, F.when(F.col("_opens"), F.col("_day_before")).otherwise(F.col("_lag")))
        .withColumn(following, F.when(F.col("_closes"), F.col("_day_after")).otherwise(F.col("_lead")))
        .drop("_lag", "_opens", "_lead", "_closes", "_day_before", "_day_after")
    )


def with_known_around(
    rows: DataFrame,
    keys: list[str],
    columns: list[str],
    order: str = "timestamp",
    both: bool = True,
) -> DataFrame:
    """Add, per column, place and value of the last known and the next known row.

    A known row is its own neighbour. Adds <column>_prev_at, <column>_prev and,
    if both, <column>_next_at, <column>_next.
    """
    per_day: list[Column] = []
    earlier, later = per_series(keys), per_series(keys, descending=True)
    state: list[Column] = []
    inside: list[Column] = []
    up = in_day(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    down = in_day(keys, order, descending=True).rowsBetween(Window.unboundedPreceding, 0)
    for c in columns:
        at = F.when(F.col(c).isNotNull(), F.col(order))
        per_day += [F.max(at).alias(f"{c}_hi_at"), F.max_by(c, at).alias(f"{c}_hi")]
        state += [
            F.last(f"{c}_hi_at", True).over(earlier).alias(f"{c}_before_at"),
            F.last(f"{c}_hi", True).over(earlier).alias(f"{c}_before"),
        ]
        inside += [
            F.last(at, True).over(up).alias(f"{c}_up_at"),
            F.last(c, True).over(up).alias(f"{c}_up"),
        ]
        if both:
            per_day += [F.min(at).alias(f"{c}_lo_at"), F.min_by(c, at).alias(f"{c}_lo")]
            state += [
                F.last(f"{c}_lo_at", True).over(later).alias(f"{c}_after_at"),
                F.last(f"{c}_lo", True).over(later).alias(f"{c}_after"),
            ]
            inside += [
                F.last(at, True).over(down).alias(f"{c}_down_at"),
                F.last(c, True).over(down).alias(f"{c}_down"),
            ]
    days = rows.groupBy(*keys, "date").agg(*per_day).select(*keys, "date", *state)
    near = join_day_state(rows.select("*", *inside), keys, days)
    out = [F.col(c) for c in rows.columns]
    for c in columns:
        out += [
            F.coalesce(f"{c}_up_at", f"{c}_before_at").alias(f"{c}_prev_at"),
            F.coalesce(f"{c}_up", f"{c}_before").alias(f"{c}_prev"),
        ]
        if both:
            out += [
                F.coalesce(f"{c}_down_at", f"{c}_after_at").alias(f"{c}_next_at"),
                F.coalesce(f"{c}_down", f"{c}_after").alias(f"{c}_next"),
            ]
    return near.select(*out)
