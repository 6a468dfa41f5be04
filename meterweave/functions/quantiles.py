"""Exact percentiles per key without gathering a key in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterweave.plans.days import join_facts


def exact_percentiles(
    rows: DataFrame, key: str, value: str, probabilities: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """(key, cutoffs): an array with each percentile, linearly interpolated between ranks.

    Rows are a series by day: they have a column `date`. A mergeable sketch, with
    a rank error of at most 1/accuracy of the rows of a key, brackets each
    percentile within three such errors. One more pre-aggregated pass counts the
    distinct values inside the brackets and, in one row per zone between them,
    the rows outside with their least and greatest value; only these rows are
    ranked. With more than `accuracy` rows both order statistics of a percentile
    lie in its bracket. With fewer, a percentile's rank and the sketch's may be
    rounded to ranks one apart, and the order statistic is then the greatest value
    of the zone below or the least of the zone above. Anything else is an error.
    """
    known = rows.select(key, "date", value).where(F.col(value).isNotNull())
    margin = 3 / accuracy
    low = [max(p - margin, 0.0) for p in probabilities]
    high = [min(p + margin, 1.0) for p in probabilities]
    sketch = known.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(value, low, accuracy).alias("low"),
        F.percentile_approx(value, high, accuracy).alias("high"),
    )
    v = F.col(value)
    inside = reduce(or_, [v.between(F.col("low")[i], F.col("high")[i]) for i in range(len(low))])
    brackets_below = sum((v > F.col("high")[i]).cast("int") for i in range(len(high)))
    counted = (
        join_facts(known, [key], sketch, "inner")
        .groupBy(key, "n", brackets_below.alias("zone"), F.when(inside, v).alias("v"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(v).alias("least"), F.max(v).alias("greatest"))
    )
    upto = Window.partitionBy(key).orderBy("zone", F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("upto", F.sum("copies").over(upto))
    first = F.col("upto") - F.col("copies")

    def at(place: Column) -> Column:
        """The value of that rank (from 0), from the row that holds it."""
        outside = F.raise_error(F.lit("the sketch of a percentile is further off than it promises")).cast("double")
        held = F.when(F.col("v").isNotNull() | (place == first), F.col("least")).when(place == F.col("upto") - 1, F.col("greatest"))
        return F.min(F.when(place.between(first, F.col("upto") - 1), held.otherwise(outside)))

    found, cutoffs = [], []
    for i, p in enumerate(probabilities):
        place = F.lit(float(p)) * (F.col("n") - 1)
        found += [at(F.floor(place)).alias(f"lower{i}"), at(F.ceil(place)).alias(f"upper{i}")]
        part = place - F.floor(place)
        cutoffs.append(F.col(f"lower{i}") + (F.col(f"upper{i}") - F.col(f"lower{i}")) * part)
    return ranked.groupBy(key, "n").agg(*found).select(key, F.array(*cutoffs).alias("cutoffs"))
