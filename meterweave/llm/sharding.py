"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterweave.llm.common import ranked

#: Blocks that stand for the source partitions. A hash of the row names the
#: block, so that a lost and repeated task finds its rows in the same one.
BLOCKS = 1024


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """Exact draw: how many of n taken from good + bad are good, by inversion outwards from the mode."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    log = math.lgamma
    choose = lambda a, b: log(a + 1) - log(b + 1) - log(a - b + 1)
    up = down = math.exp(choose(good, mode) + choose(bad, n - mode) - choose(good + bad, n))
    rest, i, j = rng.random() - up, mode, mode
    while rest > 0 and (i < high or j > low):
        if i < high:
            up *= (good - i) * (n - i) / ((i + 1) * (bad - n + i + 1))
            i, rest = i + 1, rest - up
            if rest <= 0:
                return i
        if j > low:
            down *= j * (bad - n + j) / ((good - j + 1) * (n - j + 1))
            j, rest = j - 1, rest - down
            if rest <= 0:
                return j
    return mode


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows for blocks, columns for shards: as many rows go each way as in a uniform random shuffle."""
    rng, left, matrix = random.Random(seed), list(sizes), []
    for count in counts:
        row, total = [], sum(left)
        for s, room in enumerate(left):
            got = hypergeometric(rng, room, total - room, count)
            total, count, left[s] = total - room, count - got, room - got
            row.append(got)
        matrix.append(row)
    return matrix


def shard_rows(docs: DataFrame, n_shards: int, identity: list[str], seed: int = 17, blocks: int = BLOCKS) -> DataFrame:
    """Adds shard (0 to n_shards - 1) and slot (gapless from 0 in each shard); row counts differ by one at most.

    identity: columns that tell rows apart; they decide the order, so equal
    input gives equal output however it is partitioned. Rows are dealt to
    blocks, exact block-to-shard counts are drawn (the matrix has blocks *
    n_shards numbers, whatever the input), a random order within its block sends
    each row to its shard, and a second random order within the shard sets its
    slot. Neither order sorts a shard in one task. Nulls in identity are values
    like any other; rows equal in identity are interchangeable; an empty table
    gives no rows; input columns named shard or slot are replaced.
    """
    docs = docs.drop("shard", "slot")
    dealt = docs.withColumn("__block", F.pmod(F.xxhash64(F.lit(seed), *identity), F.lit(blocks)).cast("int"))
    found = {r["__block"]: r["n"] for r in dealt.groupBy("__block").agg(F.count("*").alias("n")).collect()}
    counts, total = [found.get(b, 0) for b in range(blocks)], sum(found.values())
    sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    bounds = []
    for row in communication_matrix(counts, sizes, seed):
        ends = [sum(row[: s + 1]) for s in range(n_shards)]
        bounds.append(ends)
    ends = F.from_json(F.lit(json.dumps(bounds)), "array<array<bigint>>")
    within = Window.partitionBy("__block").orderBy(F.xxhash64(F.lit(seed + 1), *identity), *identity)
    sent = (
        dealt.withColumn("__at", F.row_number().over(within))
        .withColumn("shard", F.size(F.filter(F.element_at(ends, F.col("__block") + 1), lambda end: end < F.col("__at"))).cast("int"))
        .drop("__at", "__block")
    )
    return ranked(sent, ["shard"], F.xxhash64(F.lit(seed + 2), *identity), [F.col(c) for c in identity], F.lit(1), "slot")
