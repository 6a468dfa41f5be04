"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "meterweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # An analysis has more generated classes than the default of 100 keeps; evicted ones
        # are compiled again and start out interpreted.
        "spark.sql.codegen.cache.maxEntries": "5000",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def partitions(spark: SparkSession) -> int:
    """Partitions for an explicit layout: the session's setting, on one machine not far above its cores."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    context = spark.sparkContext
    return min(wanted, 2 * context.defaultParallelism) if context.master.startswith("local") else wanted


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a scratch folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="meterweave-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that an iterative plan stays short and survives lost executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)
