"""How the sources of a language differ in their words: summed differences of source pairs, and each source's telling terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterweave.llm.common import stored
from meterweave.llm.words import LOWER, gathered

#: Fixed value: bytes.translate table. Terms are runs of A-Z, a-z and everything beyond ASCII; A-Z are lowered.
LETTERS = bytes(LOWER.get(c, c) if c >= 0x80 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
#: Counts that a task holds before it hands them on.
HELD = 400_000
#: Sources in a block of the pair sums, and kept terms in a bucket of them.
SOURCES, TERMS = 256, 1 << 14
#: Rows that a task looks at together for a skyband, rows compared at once, and retained rows above which it hands all on.
ROWS, BLOCK, RETAINED = 1 << 18, 256, 1 << 20
#: Parts of the terms of a group whose skybands are merged apart before all are.
PARTS = 16
BAND = "lang string, source string, term string, n long, lang_n long"
COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 2) / (total + 2 * kept)), by long division three digits at a time: exact below 9e15 words."""
    whole = total + 2 * kept
    left, out = count + 2, None
    for _ in range(4):
        digits = F.call_function("div", left, whole)
        out = digits if out is None else out * 1000 + digits
        left = F.pmod(left, whole) * 1000
    return F.when(whole > 0, out + 1)


def shares(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """As share, for arrays."""
    whole = total + 2 * kept
    left, out = counts + 2, 0
    for _ in range(4):
        out = out * 1000 + left // whole
        left = left % whole * 1000
    return out + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n and docs (documents with the term), added up over what a task reads, HELD terms at a time."""
    words, texts = {}, {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in words.items():
            term = pa.array(n.keys(), pa.binary()).cast(pa.string())
            same = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(n), np.int32))) for x in (lang, source)]
            yield pa.record_batch([*same, term, pa.array(n.values(), pa.int64()), pa.array(map(texts[lang, source].__getitem__, n), pa.int64())], COUNTED)

    for batch, found in gathered(batches, "text"):
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), found, strict=True):
            terms = text.translate(LETTERS).split()
            words.setdefault((lang, source), Counter()).update(terms)
            texts.setdefault((lang, source), Counter()).update(set(terms))
        if sum(map(len, words.values())) > HELD:
            yield from rows()
            words, texts = {}, {}
    yield from rows()


def term_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """Kept terms: lang, term, lang_n, and found, the sources (in no order) with their counts.

    Tasks add up what they read; the sums are shuffled once, by (lang, term).
    """
    tasks = docs.select("lang", "source", "text").mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    by_source = tasks.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("found"))
    return by_term.where(F.col("docs") >= min_docs).drop("docs")


def band(group: np.ndarray, n: np.ndarray, lang_n: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than k others of their group dominate: n as high, lang_n as low, a lower rank.

    Rows are gone through so that those that can dominate a row come before it.
    Of the rows before a block, the retained ones tell enough: if a row has k
    dominators or more, its first k are retained themselves.
    """
    order = np.lexsort((rank, lang_n, -n, group))
    edges = [0, *(np.flatnonzero(np.diff(group[order])) + 1), len(order)]
    kept = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        held = np.zeros(0, np.int64)
        for at in range(low, high, BLOCK):
            rows = order[at : min(at + BLOCK, high)]
            before = np.concatenate([held, rows])
            over = (lang_n[before] <= lang_n[rows, None]) & (rank[before] < rank[rows, None])
            over[:, len(held) :] &= np.tri(len(rows), k=-1, dtype=bool)
            held = np.concatenate([held, rows[over.sum(1) < k]])
        kept.append(held)
    return np.concatenate(kept) if kept else order


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """The rows that fewer than k others of their (lang, source) and their partition dominate."""

    def retained(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        code = lambda name: pc.dictionary_encode(table.column(name).combine_chunks()).indices.to_numpy(zero_copy_only=False).astype(np.int64)
        rank = np.empty(len(table), np.int64)
        rank[pc.sort_indices(table.column("term")).to_numpy()] = np.arange(len(table))
        group = code("lang") * len(table) + code("source")
        return table.take(band(group, table.column("n").to_numpy(), table.column("lang_n").to_numpy(), rank, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held, new, n_new = None, [], 0
        for batch in batches:
            new.append(batch)
            n_new += len(batch)
            if n_new >= max(ROWS, len(held) if held else 0):
                held, new, n_new = retained(pa.concat_tables([*([held] if held else []), pa.Table.from_batches(new)])), [], 0
                if len(held) > RETAINED:
                    yield from held.to_batches()
                    held = None
        if held or new:
            yield from retained(pa.concat_tables([*([held] if held else []), *([pa.Table.from_batches(new)] if new else [])])).to_batches()

    return rows.select("lang", "source", "term", "n", "lang_n").mapInArrow(run, BAND)


def pair_sums(found: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (two sources of the language) and value, gap summed over the kept terms.

    Sources are dealt to blocks and terms to buckets by a hash; a task adds up
    one bucket for two blocks. The pairs of sources are the result and are made
    only there.
    """
    n_sources, kept = groups.groupBy("lang").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).agg(F.max("n"), F.max("kept")).first()
    n_blocks, n_buckets = -(-(n_sources or 1) // SOURCES), -(-(kept or 1) // TERMS)
    dealt = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    block = lambda source: dealt(source, n_blocks)
    later = F.explode(F.sequence("a", F.lit(n_blocks - 1))).alias("b")
    members = groups.withColumn("block", block(F.col("source"))).groupBy("lang", "block").agg(
        F.collect_list(F.struct("source", "total")).alias("members"), F.first("kept").alias("kept")
    )
    two = members.select("lang", F.col("block").alias("a"), F.col("members").alias("left"), "kept").join(
        members.select("lang", F.col("block").alias("b"), F.col("members").alias("right")), "lang"
    ).where("a <= b").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))))
    terms = found.select("lang", "found", dealt("term", n_buckets).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("a")).select("*", later)
    inside = lambda x: F.filter("found", lambda f: block(f["source"]) == F.col(x))
    counts = terms.select("lang", "a", "b", "bucket", inside("a").alias("left"), inside("b").alias("right"))

    def dense(lists: pa.ListArray, names: pa.Array) -> np.ndarray:
        out, flat = np.zeros((len(lists), len(names)), np.int64), lists.flatten()
        out[lists.value_parent_indices().to_numpy(zero_copy_only=False), pc.index_in(flat.field("source"), names).to_numpy(zero_copy_only=False)] = flat.field("n").to_numpy(zero_copy_only=False)
        return out

    def added(key: tuple, counts: pa.Table, work: pa.Table) -> pa.Table:
        same, parts = key[1].as_py() == key[2].as_py(), []
        for row in work.to_pylist():
            names, totals = {}, {}
            for side in ("left", "right"):
                names[side] = pa.array([m["source"] for m in row[side]], pa.string())
                totals[side] = np.array([m["total"] for m in row[side]], np.int64)
            value = np.zeros((len(names["left"]), len(names["right"])), np.int64)
            for batch in counts.to_batches(max_chunksize=2048):
                p, q = (shares(dense(batch.column(side), names[side]), totals[side], row["kept"]) for side in ("left", "right"))
                for i in range(value.shape[0]):
                    x = p[:, i, None]
                    value[i] += ((x - q) ** 2 // (x + q)).sum(0)
            i, j = np.nonzero(~np.eye(*value.shape, dtype=bool) if same else np.ones(value.shape, bool))
            lang = pa.array([row["lang"]] * len(i), pa.string())
            ways = [("left", i, "right", j)] if same else [("left", i, "right", j), ("right", j, "left", i)]
            parts += [pa.table([lang, names[a].take(x), names[b].take(y), pa.array(value[i, j])], ["lang", "source", "item", "value"]) for a, x, b, y in ways]
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.string(), pa.int64())], ["lang", "source", "item", "value"])

    key = ["lang", "a", "b", "bucket"]
    sums = counts.groupBy(*key).cogroup(two.groupBy(*key)).applyInArrow(added, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """Rows of part `pair` and `term` for every (lang, source): lang, source, part, item, value, rank.

    A language keeps the terms in at least min_docs of its documents. A kept
    term's share in a group is 1 + floor(10^9 * (count + 2) / (N + 2V)): N is
    the group's occurrences of kept terms, V the number of kept terms. The gap
    of two shares is floor((p - q)^2 / (p + q)). `pair` has the gap to every
    other source of the language, summed over its kept terms; `term` the top
    terms whose share in the source is above that in the whole language. Ranks
    go by value, then by the bytes of the item.

    For one group the gap never falls as its count rises, nor as the language's
    count falls. A term that `top` others dominate in both and in earlier bytes
    is so not among the first `top`: partitions keep the skybands of their
    terms, these are merged, and only what is left is ranked.

    docs has text, lang and source, other columns are ignored; nulls are empty
    strings. Every row is a document, whether repeated or not. A source without
    terms has shares of its own; a language without kept terms has pairs of
    value 0; a language of one source has no pairs. An empty table gives no rows.
    """
    docs = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    found = stored(term_counts(docs, min_docs), "term-counts")
    each = found.select("lang", "term", "lang_n", F.explode("found").alias("f")).select("lang", "f.source", "term", "f.n", "lang_n")
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = found.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    groups = stored(groups, "source-totals")

    part = F.pmod(F.xxhash64("term"), F.lit(PARTS))
    merged = skyband(skyband(each, top).repartition("lang", "source", part), top).repartition("lang", "source")
    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    ahead = skyband(merged, top).join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    terms = ahead.select("lang", "source", F.lit("term").alias("part"), "item", gap(F.col("p"), F.col("q")).alias("value"))
    pairs = pair_sums(found, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).unionByName(pairs.withColumn("rank", F.row_number().over(best)))
