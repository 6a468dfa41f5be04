"""Run queries and their SQL side by side: python -m checks.compare <sf_dir> [query ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    columns = sorted(pdf.columns)
    cleaned = pdf[columns].astype(object).where(pdf[columns].notna(), None)
    return sorted((tuple(row) for row in cleaned.itertuples(index=False)), key=lambda row: tuple(map(str, row)))


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, key: str) -> str | None:
    """None if both sides agree, else what differs first."""
    ours = QUERIES[key](spark, sf_dir).toPandas()
    theirs = con.execute(ORACLES[key]).df()
    for c in ours.columns:
        if c in theirs and str(ours[c].dtype) != str(theirs[c].dtype):
            if "datetime" in str(theirs[c].dtype) or "datetime" in str(ours[c].dtype):
                ours[c], theirs[c] = pd.to_datetime(ours[c]), pd.to_datetime(theirs[c])
                ours[c], theirs[c] = ours[c].astype("datetime64[us]"), theirs[c].astype("datetime64[us]")
            elif any(str(t[c].dtype).startswith(("int", "float")) for t in (ours, theirs)):
                ours[c], theirs[c] = ours[c].astype("float64"), theirs[c].astype("float64")
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    a, b = rows_of(ours), rows_of(theirs)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ in {sorted(ours.columns)}, first {wrong[0][0]} / {wrong[0][1]}"
    return None


def main() -> None:
    from meterweave.session import session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    for key in only or QUERIES:
        start = time.time()
        try:
            if key in ORACLES:
                found = difference(spark, con, sf_dir, key) or "ok"
            else:
                found = f"no SQL, {len(QUERIES[key](spark, sf_dir).toPandas())} rows"
        except Exception as error:  # report and go on with the next query
            found = f"FAILED {str(error)[:400]}"
        print(f"{key:28s} {time.time() - start:6.1f}s  {found}", flush=True)


if __name__ == "__main__":
    main()
