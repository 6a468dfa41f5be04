"""Writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterweave.session import partitions


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Files with the rows of a key together and sorted, so that a reader of one key skips most of them.

    The rebalance hint evens out file sizes and lets Spark split a key that is too large for one task.
    """
    keys = [c for c in ("entity_id", "meter_id", "date", "timestamp") if c in df.columns]
    if keys:
        df = df.hint("rebalance", keys[0]).sortWithinPartitions(*keys)
    _save(df.write.mode("overwrite"), path, file_format)


def write_per_entity(df: DataFrame, path: str, file_format: str = "csv", key: str = "entity_id") -> None:
    """One folder per entity, for consumers that open an entity's files by name.

    Only the folders of entities in df are replaced, all at once when the write
    ends: a run for some entities, or a repeated one, leaves the others as they
    are. Folders are as many as entities; for many meters write_table is the
    better layout.
    """
    rows = df.repartition(partitions(df.sparkSession), key)
    replaced = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _save(replaced.partitionBy(key), path, file_format)


def _save(writer, path: str, file_format: str) -> None:
    if file_format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(file_format).save(path)


def write_outputs(
    tables: dict[str, DataFrame], folder: str, file_format: str = "parquet", per_entity: bool = False
) -> dict[str, str]:
    """Write each named table below `folder`; returns the path of each.

    Only rows that exist are written: per entity, one without patterns or events has no folder.
    Lists of dates become text in CSV.
    """
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        if file_format == "csv":
            df = df.selectExpr(
                *[
                    f"concat_ws(';', cast({f.name} AS array<string>)) AS {f.name}"
                    if f.dataType.typeName() == "array"
                    else f.name
                    for f in df.schema
                ]
            )
        if per_entity and "entity_id" in df.columns:
            write_per_entity(df, paths[name], file_format)
        else:
            write_table(df, paths[name], file_format)
    return paths
