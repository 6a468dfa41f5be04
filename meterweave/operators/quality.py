"""Data quality of filled observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterweave import schema
from meterweave.operators.gaps import observed_and_runs


def quality_summary(observations: DataFrame) -> DataFrame:
    """Counts, shares and the longest gap per meter, and a PORTFOLIO row over all meters.

    The total row takes the sums and the single worst gap; runs are never merged
    across meters. Of equal gaps the earliest wins, then the lowest meter id.
    """
    is_gap = ~F.col("is_observed")
    gap = F.struct(
        F.col("n_intervals").alias("size"), F.col("first_at").alias("start"), F.col("last_at").alias("end")
    )
    meters = observed_and_runs(observations).groupBy("meter_id").agg(
        F.sum("n_intervals").alias("n_intervals"),
        F.sum(F.when(F.col("is_observed"), F.col("n_intervals")).otherwise(0)).alias("n_observed"),
        F.sum("n_interpolated").alias("n_interpolated"),
        F.count_if(is_gap).alias("n_gap_events"),
        F.min_by(gap, F.when(is_gap, F.struct(-F.col("n_intervals"), "first_at"))).alias("gap"),
    )
    # Each meter's row counts once for itself and once for the total.
    fanned = meters.withColumn("is_total", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn(
        "row_id", F.when(F.col("is_total"), F.lit(schema.TOTAL_ROW_ID)).otherwise(F.col("meter_id"))
    )
    longest = F.min_by(
        "gap",
        F.when(
            F.col("gap").isNotNull(),
            F.struct(-F.col("gap.size"), F.col("meter_id")),
        ),
    )
    merged = fanned.groupBy("is_total", "row_id").agg(
        F.sum("n_intervals").alias("n_intervals"),
        F.sum("n_observed").alias("n_observed"),
        F.sum("n_interpolated").alias("n_interpolated"),
        F.sum("n_gap_events").alias("n_gap_events"),
        longest.alias("gap"),
    ).withColumn("n_missing", F.expr("n_intervals - n_observed - n_interpolated"))

    def share(part: str):
        return F.bround(100 * F.col(part) / F.col("n_intervals"), 2)

    return merged.select(
        F.col("row_id").alias("meter_id"),
        "n_intervals",
        "n_observed", share("n_observed").alias("pct_observed"),
        "n_interpolated", share("n_interpolated").alias("pct_interpolated"),
        "n_missing", share("n_missing").alias("pct_missing"),
        "n_gap_events",
        F.coalesce("gap.size", F.lit(0)).alias("max_gap_intervals"),
        F.col("gap.start").alias("max_gap_start"),
        F.col("gap.end").alias("max_gap_end"),
    )


def quality_detail(observations: DataFrame) -> DataFrame:
    """Every non-observed interval with its flag."""
    return observations.where(~F.col("is_observed")).select(
        "meter_id", "timestamp", "data_quality_flag"
    )


def quality_flag_counts(observations: DataFrame) -> DataFrame:
    return observations.groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("n_intervals"))
