"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterweave.llm.common import folder, union

#: Characters stripped from both ends of a line, and the letters that are lowered.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER)


def text_lines(text: Column | str) -> Column:
    """Lines of a text; null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line (index from 0), h1, h2 (128 bits of the key), chars (code points of the key).

    text_hash, with the id, names the row: rows equal in both have the same lines.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(text_lines("text")).alias("line", "__text"))
    key = line_key(F.col("__text"))
    return lines.select(
        "doc_id", "text_hash", "line", F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"), F.length(key).alias("chars"),
    )


class LineRuns:
    """Sorted runs of line hashes with the number of documents each was seen in, kept on levels in a shared folder.

    A batch adds one run to level 0. A level that holds `fanout` runs is
    compacted: its runs are merged into one run of the next level, so that a
    hash lies in at most fanout runs per level and every entry is rewritten only
    once per level. Runs are Parquet files, dealt and sorted by the hash.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, path: str | None = None):
        self.spark, self.fanout, self.path = spark, fanout, path or folder(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, entries: DataFrame, level: int) -> None:
        at = f"{self.path}/level-{level}-run-{self.written}"
        self.written += 1
        entries.sortWithinPartitions(*KEY).write.parquet(at)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(at)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(merged([self._read(x) for x in full]), level + 1)

    def _read(self, at: str) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, chars int, n_docs long").parquet(at)

    def add(self, counts: DataFrame) -> None:
        """Adds a batch: one row per hash with the number of its documents in the batch."""
        self._write(counts, 0)

    def entries(self) -> DataFrame:
        """Every hash once, with its documents in all batches."""
        runs = [self._read(x) for level in self.levels for x in level]
        return merged(runs) if runs else self.spark.createDataFrame([], "h1 long, h2 long, chars int, n_docs long")

    def unseen(self, counts: DataFrame) -> DataFrame:
        """The part of a batch that no run holds: a merge anti join with each run."""
        for level in self.levels:
            for at in level:
                counts = counts.join(self._read(at).select(*KEY).hint("merge"), KEY, "left_anti")
        return counts


def merged(runs: list[DataFrame]) -> DataFrame:
    return union(runs).groupBy(*KEY).agg(F.first("chars").alias("chars"), F.sum("n_docs").alias("n_docs"))


def batch_counts(docs: DataFrame) -> DataFrame:
    """One row per hash: chars and n_docs, the number of rows of docs with the line; a row counts once, whether repeated or not."""
    keys = docs.select(F.explode(F.array_distinct(F.transform(text_lines("text"), line_key))).alias("key"))
    hashed = keys.select(F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"), F.length("key").alias("chars"))
    return hashed.groupBy(*KEY).agg(F.first("chars").alias("chars"), F.count("*").alias("n_docs"))


def line_runs(docs: DataFrame, batches: int = 4, fanout: int = 4, path: str | None = None) -> LineRuns:
    """Runs over the documents, which arrive in `batches` parts by a hash of the row."""
    runs = LineRuns(docs.sparkSession, fanout, path)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    for b in range(batches):
        runs.add(batch_counts(docs.where(part == b)))
    return runs


def drop_frequent_lines(docs: DataFrame, runs: LineRuns, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Documents without the lines whose key is in min_docs documents or more, over all batches of the runs.

    Returns doc_id, n_lines (before), n_dropped and text (other lines, joined by
    line feeds). docs has doc_id and text, other columns are ignored. Keys of
    fewer than min_chars code points always stay. Null and empty text are one
    empty line. Every row is a document: null ids are ids like any other, and rows
    equal in id and text count each and are each returned. Empty tables give no
    rows.
    """
    frequent = runs.entries().where((F.col("n_docs") >= min_docs) & (F.col("chars") >= min_chars)).select(*KEY)
    dropped = (
        line_hashes(docs).where(F.col("chars") >= min_chars).join(frequent, KEY, "left_semi")
        .groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(F.collect_set("line").alias("__dropped"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__hash"))
    joined = docs.select("doc_id", "text").join(dropped, same, "left").select("doc_id", text_lines("text").alias("__lines"), F.coalesce("__dropped", F.array().cast("array<int>")).alias("__dropped"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    text = F.when(F.size("__dropped") == 0, F.array_join("__lines", "\n")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n"))
    return joined.select("doc_id", F.size("__lines").cast("long").alias("n_lines"), F.size("__dropped").cast("long").alias("n_dropped"), text.alias("text"))
