"""Approximate nearest neighbours by inner product: a forest of random-projection trees with one shared queue."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterweave.llm.common import stored

TREES = 8
#: Least rows of a leaf; leaves that a query looks into, over all trees: so many and this share of them at least.
LEAF_ROWS, PROBES, PROBED = 400, 160, 5 / 32
#: Rows from which the trees are grown, and the least of them in a leaf.
SAMPLE, LEAF_SAMPLE = 20_000, 8
KEY = ["h1", "h2"]


@dataclass
class Forest:
    """Complete binary trees: the direction and threshold of every inner node, level by level."""

    direction: np.ndarray
    threshold: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree; leaves are numbered through all trees."""
        trees, out = len(self.direction), np.empty((len(x), len(self.direction)), np.int64)
        for t in range(trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", x, self.direction[t][node]) > self.threshold[t][node]
                node = 2 * node + 1 + right
            out[:, t] = node - (2**self.depth - 1) + t * 2**self.depth
        return out

    def nearest_leaves(self, query: np.ndarray, probes: int) -> list[int]:
        """The leaves to look into, best first: one queue holds the nodes of all trees by the worst margin on their way."""
        trees, inner = len(self.direction), 2**self.depth - 1
        margin = (self.direction @ query - self.threshold).tolist() if inner else [[]] * trees
        queue, out = [(0.0, t, 0) for t in range(trees)], []
        while queue and len(out) < probes:
            worst, t, node = heapq.heappop(queue)
            while node < inner:
                m = margin[t][node]
                near, far = (2 * node + 2, 2 * node + 1) if m > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(worst, abs(m)), t, far))
                node = near
            out.append(node - inner + t * (inner + 1))
        return out


def grow(sample: np.ndarray, trees: int, depth: int, seed: int) -> Forest:
    """Random directions; every node halves its part of the sample."""
    rng, inner, dim = np.random.default_rng(seed), 2**depth - 1, sample.shape[1]
    direction = rng.normal(size=(trees, inner, dim))
    direction /= np.linalg.norm(direction, axis=2, keepdims=True)
    threshold = np.zeros((trees, inner))
    for t in range(trees):
        node = np.zeros(len(sample), np.int64)
        for level in range(depth):
            place = np.einsum("ij,ij->i", sample, direction[t][node])
            for i in range(2**level - 1, 2 ** (level + 1) - 1):
                here = place[node == i]
                threshold[t, i] = np.median(here) if len(here) else 0.0
            node = 2 * node + 1 + (place > threshold[t][node])
    return Forest(direction, threshold, depth)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component that makes all vectors as long as the longest: then the nearest has the largest inner product."""
    return np.hstack([x, np.sqrt(np.maximum(0, longest**2 - (x * x).sum(1)))[:, None]])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, h1, h2 of the vectors that take part."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    rows = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(finite & some, F.lit(False)))
    return rows.withColumn("h1", F.xxhash64(F.lit(1), "embedding")).withColumn("h2", F.xxhash64(F.lit(2), "embedding"))


FOUND = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("found", pa.list_(pa.struct([("less", pa.float64()), ("vec_id", pa.int64())])))])


def best_in_leaf(k: int):
    """For each query the k best entries of the leaf with all their ids; less is the score with its sign turned."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(queries) or not len(rows):
            return FOUND.empty_table()
        x, ids = matrix(rows["embedding"].combine_chunks()), rows["ids"].combine_chunks()
        n_ids, flat = ids.value_lengths().to_numpy(), ids.flatten().to_numpy()
        at, parts = np.cumsum(n_ids) - n_ids, []
        asked = queries["embedding"].combine_chunks()
        by_id = np.argsort(flat[at], kind="stable")
        for low in range(0, len(queries), 256):
            q = matrix(asked.slice(low, 256))
            near = by_id[np.argsort(-(q @ x.T)[:, by_id], axis=1, kind="stable")[:, :k]]
            exact = (x[near] * q[:, None, :]).sum(2)
            size = n_ids[near]
            each = np.repeat(at[near].ravel(), size.ravel()) + np.arange(size.sum()) - np.repeat(np.cumsum(size.ravel()) - size.ravel(), size.ravel())
            entry = pa.StructArray.from_arrays([pa.array(-np.repeat(exact.ravel(), size.ravel())), pa.array(flat[each])], fields=list(FOUND.field("found").type.value_type))
            ends = np.concatenate([[0], np.cumsum(size.sum(1))])
            parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entry))
        return pa.table([queries["h1"], queries["h2"], pa.chunked_array(parts)], names=FOUND.names).cast(FOUND)

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, probes: int = PROBES, leaf_rows: int = LEAF_ROWS, sample: int = SAMPLE, seed: int = 11) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products found for every query, ties to the smaller id.

    vectors has vec_id and embedding; is_query says which rows ask. Every row
    but the query's own is a candidate. Trees are grown from some `sample` rows,
    picked by a hash; every distinct vector is then put into its leaf of each
    tree. A query looks into `probes` leaves, or the share PROBED of all if that
    is more, and ranks all rows in them by their exact score. Equal vectors are one entry that carries its k + 1 smallest
    ids, which is all that any query can return, so copies make no leaf large;
    queries of equal vectors are searched once.

    Vectors that are null, zero or hold null or non-finite components, rows
    without id, and vectors of another than the most frequent length take no
    part. Equal rows are one row. An empty table gives no rows.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    lengths = sorted(rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect(), key=lambda r: (-r["n"], r["d"]))
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == lengths[0]["d"])
    order = Window.partitionBy(*KEY).orderBy("vec_id")
    entries = rows.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= k + 1)
    entries = stored(entries.groupBy(*KEY).agg(F.first("embedding").alias("embedding"), F.sort_array(F.collect_set("vec_id")).alias("ids")), "vectors")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    n, longest = entries.agg(F.count("*"), F.max(norm)).first()
    part = 1 << 30
    picked = entries.where(F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(part)) < int(part * min(1.0, sample / n))).select(*KEY, "embedding")
    grown = picked.toArrow().sort_by([("h1", "ascending"), ("h2", "ascending")])
    depth = max(0, int(math.log2(max(1.0, min(n / leaf_rows, len(grown) / LEAF_SAMPLE)))))
    probes = max(probes, math.ceil(PROBED * trees * 2**depth))
    held = vectors.sparkSession.sparkContext.broadcast(grow(lifted(matrix(grown["embedding"].combine_chunks()), longest), trees, depth, seed))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = held.value.leaves(lifted(matrix(batch.column(0)), longest))
            for t in range(trees):
                yield pa.record_batch([pa.array(leaves[:, t], pa.int64()), batch.column(0), batch.column(1)], names=["leaf", "embedding", "ids"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column(2))
            q = np.hstack([q, np.zeros((len(q), 1))])
            step = max(1, 10_240 // probes)
            for low in range(0, len(q), step):
                leaves = [held.value.nearest_leaves(x, probes) for x in q[low : low + step]]
                row = np.repeat(np.arange(len(leaves)), [len(x) for x in leaves])
                again = batch.slice(low, len(leaves)).take(pa.array(row))
                yield pa.record_batch([pa.array([x for y in leaves for x in y], pa.int64()), *again.columns], names=["leaf", "h1", "h2", "embedding"])

    kind = dict(entries.dtypes)["embedding"]
    stored_rows = entries.select("embedding", "ids").mapInArrow(index, f"leaf long, embedding {kind}, ids array<long>")
    asking = rows.where(is_query)
    distinct = asking.select(*KEY).distinct().join(entries, KEY).select(*KEY, "embedding")
    asked = distinct.mapInArrow(search, f"leaf long, h1 long, h2 long, embedding {kind}")
    found = asked.groupBy("leaf").cogroup(stored_rows.groupBy("leaf")).applyInArrow(best_in_leaf(k + 1), "h1 long, h2 long, found array<struct<less:double,vec_id:long>>")
    # At most probes * (k + 1) entries a query. A vector is found once in each tree at most, so the
    # best (k + 1) * trees hold k + 1 different ones.
    top = F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, (k + 1) * trees)
    best = found.groupBy(*KEY).agg(top.alias("top")).select(*KEY, F.filter("top", lambda f, i: (i == 0) | (f != F.get("top", i - 1))).alias("found"))
    each = asking.select(F.col("vec_id").alias("query_id"), *KEY).distinct().join(best, KEY)
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    put = each.select("query_id", F.posexplode(others).alias("rank", "f"))
    return put.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.less")).alias("score"))
