"""Findings on canonical text readings, duplicate removal, and the gate before analysis."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from meterweave import schema
from meterweave.sources.readings import as_number, as_timestamp, canonicalize

FINDING = "severity string, message string, section string, n bigint"


class ValidationError(RuntimeError):
    """Raised when fatal findings are present."""


#: What is counted, and how a finding says it.
TEXTS = {
    "unparsable_timestamp": "timestamp value(s) failed to parse",
    "nonnumeric_demand": "demand_kw value(s) are nonnumeric",
    "negative_demand": "negative demand_kw value(s) detected; negative demand is not supported",
    "missing_meter_id": "row(s) missing meter_id",
    "duplicate_timestamp": "duplicate (meter_id, timestamp) record(s) detected",
}


def _absent(rows: DataFrame) -> DataFrame | None:
    """Findings on required columns that rows do not have; None if it has all."""
    absent = [c for c in schema.REQUIRED_COLUMNS if c not in rows.columns]
    found = [(schema.ERROR, f"Required column '{c}' missing after mapping", "ingestion", 1) for c in absent]
    return rows.sparkSession.createDataFrame(found, FINDING) if found else None


def _counts(given: Column, kw: Column) -> list[Column]:
    """What goes into a group of rows of one meter and stamp."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(given & kw.isNull()).alias("nonnumeric"),
        F.count_if(kw < 0).alias("negative"),
    ]


def _findings(groups: DataFrame, severities: dict[str, str] | None) -> DataFrame:
    """Findings from the counts per (meter_id, timestamp); duplicates are the surplus over the number of groups."""
    levels = {**dict.fromkeys(TEXTS, schema.ERROR), **{k: v.upper() for k, v in (severities or {}).items()}}
    counts = groups.agg(
        F.sum(F.when(F.col("timestamp").isNull(), F.col("n"))).alias("unparsable_timestamp"),
        F.sum("nonnumeric").alias("nonnumeric_demand"),
        F.sum("negative").alias("negative_demand"),
        F.sum(F.when(F.col("meter_id").isNull(), F.col("n"))).alias("missing_meter_id"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicate_timestamp"),
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(levels[k]).alias("severity"),
                F.concat_ws(" ", F.col(k).cast("string"), F.lit(text)).alias("message"),
                F.lit("ingestion").alias("section"),
                F.col(k).alias("n"),
            )
            for k, text in TEXTS.items()
        ]
    )
    return counts.select(F.inline(entries)).where("n > 0")


def validate_readings(
    rows: DataFrame, severities: dict[str, str] | None = None, pattern: str | list[str] | None = None
) -> DataFrame:
    """Findings (severity, message, section, n) with n > 0.

    One pass: rows are pre-aggregated by (meter, stamp). A missing required
    column stops the check.
    """
    absent = _absent(rows)
    if absent is not None:
        return absent
    stamp = as_timestamp("timestamp", rows.schema["timestamp"].dataType, pattern)
    typed = rows.select("meter_id", stamp.alias("timestamp"), F.col("demand_kw").isNotNull().alias("given"), as_number("demand_kw").alias("kw"))
    return _findings(typed.groupBy("meter_id", "timestamp").agg(*_counts(F.col("given"), F.col("kw"))), severities)


def counted_readings(
    rows: DataFrame, stage: Callable[[DataFrame, str], DataFrame], ordinal: str | None = None,
    severities: dict[str, str] | None = None, pattern: str | list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(canonical rows without duplicates, findings), from one reading of the source.

    The aggregation that takes duplicates out counts on the way what went into
    each row. Its result is staged; the findings are summed over the counts
    there. rows have canonical names.
    """
    absent = _absent(rows)
    if absent is not None:
        return rows, absent
    given = rows.withColumn("_given", F.col("demand_kw").isNotNull())
    kept = _deduped(canonicalize(given, None, pattern), ordinal, _counts(F.col("_given"), F.col("demand_kw")))
    staged = stage(kept.drop("_given"), "readings")
    counts = ["n", "nonnumeric", "negative"]
    named = staged.select("meter_id", "timestamp", *[F.col(f"_{c}").alias(c) for c in counts])
    return staged.drop(*[f"_{c}" for c in counts]), _findings(named, severities)


def fatal_findings(findings: DataFrame, strict: bool = False) -> DataFrame:
    """Findings that stop the analysis. Duplicates do not: they are removed."""
    duplicates = (F.col("section") == "ingestion") & F.lower("message").contains("duplicate")
    severities = [schema.ERROR, schema.WARNING] if strict else [schema.ERROR]
    return findings.where(F.col("severity").isin(severities) & ~duplicates)


def raise_if_fatal(findings: DataFrame, strict: bool = False) -> None:
    """Raise ValidationError; a findings table has a handful of rows."""
    fatal = fatal_findings(findings, strict).collect()
    if fatal:
        raise ValidationError("; ".join(f"[{r.severity}] {r.section}: {r.message}" for r in fatal))


def dedupe_readings(rows: DataFrame, ordinal: str | None = None) -> DataFrame:
    """One row per (meter_id, timestamp).

    Keeps the first whole row by `ordinal`, the source order; a NULL ordinal
    comes last. Tables have no order of their own: where the ordinal repeats or
    there is none, the lowest non-null demand is kept. Written as an
    aggregation, so copies go before the shuffle.
    """
    return _deduped(rows, ordinal, [])


def _deduped(rows: DataFrame, ordinal: str | None, counts: list[Column]) -> DataFrame:
    keys = ["meter_id", "timestamp"]
    rest = [c for c in rows.columns if c not in keys]
    first = [F.col(ordinal).isNull(), F.col(ordinal)] if ordinal else []
    order = [*first, F.col("demand_kw").isNull(), *[F.col(c) for c in sorted(rest, key=lambda c: c != "demand_kw")]]
    kept = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("kept"), *counts)
    found = [F.col(c).alias(f"_{c}") for c in kept.columns if c not in (*keys, "kept")]
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.{c}") for c in rows.columns], *found)
