"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterweave.session import checkpoint_dir

#: Fixed value: white space that separates words, as a regular expression class without brackets.
SPACE = r"\x20\x09-\x0D"
#: Spark's setting that a query's shuffle files go when it ends (from 4.1 on; older ones ignore it).
SHUFFLES_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Top bits of a 64-bit hash that name a rank bucket.
BUCKET_BITS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the one that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, freed: bool = False) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends, lost executors lose nothing.

    With freed, the shuffle files behind it go when it is written, and not when the driver's garbage is collected.
    """
    path, conf = folder(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLES_FREED, None)
    if freed:
        conf.set(SHUFFLES_FREED, "true")
    try:
        df.write.parquet(path)
    finally:
        if freed:
            conf.unset(SHUFFLES_FREED) if before is None else conf.set(SHUFFLES_FREED, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))), F.lit(n))


def word_count(text: Column | str) -> Column:
    """Number of words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def ranked(df: DataFrame, group: list[str], key: Column, ties: list[Column], weight: Column, out: str) -> DataFrame:
    """Sum of weight over the rows of the group that come before each row in the order of (key, ties).

    key is a 64-bit hash. Its top bits deal every group into buckets whose sums
    are added up first, so that no task sorts a whole group. The columns of
    group must not be null.
    """
    size, at = f"{out}__w", [*group, f"{out}__b"]
    keyed = df.withColumn(f"{out}__k", key).withColumn(size, weight).withColumn(at[-1], F.shiftrightunsigned(f"{out}__k", 64 - BUCKET_BITS).cast("int"))
    sums = keyed.groupBy(*at).agg(F.sum(size).alias(f"{out}__s"))
    whole = Window.partitionBy(*group).orderBy(at[-1]).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*at, F.coalesce(F.sum(f"{out}__s").over(whole), F.lit(0)).alias(f"{out}__s"))
    inside = Window.partitionBy(*at).orderBy(f"{out}__k", *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = keyed.join(starts, at).withColumn(out, F.col(f"{out}__s") + F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return joined.select(*df.columns, F.col(out).cast("long").alias(out))
