"""K-means over the day vectors of each series, for all series in one job.

A series is an entity with a kind of values (absolute or normalized). Its days
are split into blocks of bounded size, so a long series is spread over tasks.
Each pass joins blocks with the models of their series by key, works on one
block in numpy, and Spark adds up what the blocks return: candidate seeds,
cluster sums, distance sums. A series that fits one block needs no second pass.

Of the restarts the lowest squared error wins. Clusters are numbered by size,
then by level, so that numbers can be compared between runs. An empty cluster
keeps its centre.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterweave.operators.profiles import normalized_profiles
from meterweave.session import cut_lineage, partitions

# Tasks get the functions below with the job, wherever this package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SERIES = ["entity_id", "kind"]
BLOCK_DAYS = 1024
STILL = 1e-9


# Kind of vector -> profile column.
KINDS = {"absolute": "demand_kw", "normalized": "normalized_demand"}


def day_vectors(profiles: DataFrame, kinds: tuple[str, ...] = ("absolute", "normalized")) -> DataFrame:
    """(entity_id, kind, date, vector) for complete days without a missing cell.

    Profiles are laid out by day already; both kinds are gathered in one pass.
    """
    cells = normalized_profiles(profiles.where("is_complete_day"))
    columns = [KINDS[kind] for kind in kinds]
    days = cells.groupBy("entity_id", "date").agg(
        F.sort_array(F.collect_list(F.struct("interval_index", *columns))).alias("cells")
    )
    vectors = F.array(*[F.struct(F.lit(k).alias("kind"), F.col("cells")[KINDS[k]].alias("vector")) for k in kinds])
    known = ~F.exists("vector", lambda v: v.isNull())
    return days.select("entity_id", "date", F.inline(vectors)).where(known).select(*SERIES, "date", "vector")


# Work on one block


def _uniform(days: np.ndarray, *salts: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the day and the salts only, not on partitions."""
    z = days.astype(np.uint64)
    with np.errstate(over="ignore"):
        for salt in salts:
            z = z * np.uint64(6364136223846793005) + np.uint64(2 * salt + 1442695040888963407)
            z ^= z >> np.uint64(31)
            z *= np.uint64(0x9E3779B97F4A7C15)
            z ^= z >> np.uint64(29)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gaps = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.maximum(gaps, 0)


def _matrix(days: pd.DataFrame) -> np.ndarray:
    return np.stack(days["vector"].to_numpy())


def _centres(flat, width: int) -> np.ndarray:
    return np.asarray(flat, dtype=float).reshape(-1, width)


def _grow_seeds(seed: int):
    """One more seed per restart, drawn with odds by squared distance; all seeds if the block is the series.

    The draw is a race: the day with the least -log(u) / distance wins, within a
    block here and between blocks by the minimum of `race`.
    """

    def grow(key, days: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(days)
        number = pd.to_datetime(days["date"]).to_numpy().astype("datetime64[D]").astype(np.int64)
        out = []
        for s in states.itertuples():
            chosen, race = _centres(s.seeds, x.shape[1]), 0.0
            near = _squares(x, chosen).min(1) if len(chosen) else np.ones(len(x))
            for _ in range(s.k_max if s.n_blocks == 1 else 1):
                if len(chosen) >= s.k_max:
                    break
                draw = -np.log(_uniform(number, seed, s.restart, len(chosen)))
                draw = np.where(near > 0, draw / np.where(near > 0, near, 1), np.inf)
                i = int(draw.argmin())
                race, first = float(draw[i]), not len(chosen)
                chosen = np.vstack([chosen, x[i : i + 1]])
                reach = _squares(x, x[i : i + 1])[:, 0]
                near = reach if first else np.minimum(near, reach)
            out.append((*key[:2], s.restart, s.k_max, s.n_blocks, race, chosen.ravel()))
        return pd.DataFrame(out, columns=["entity_id", "kind", "restart", "k_max", "n_blocks", "race", "seeds"])

    return grow


def _move_centres(max_iter: int):
    """Cluster sums of the block for the given centres; settled ones if the block is the series."""

    def move(key, days: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(days)
        out = []
        for m in models.itertuples():
            centres = _centres(m.centres, x.shape[1])
            for _ in range(max_iter if m.n_blocks == 1 else 1):
                gaps = _squares(x, centres)
                member = np.eye(len(centres))[gaps.argmin(1)]
                size, total = member.sum(0), member.T @ x
                moved = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
                if m.n_blocks > 1 or ((moved - centres) ** 2).sum() <= STILL:
                    break
                centres = moved
            error = (member * gaps).sum(0)
            for c in range(len(centres)):
                out.append((*key[:2], m.k, m.restart, m.n_blocks, c, size[c], total[c], centres[c], error[c]))
        return pd.DataFrame(
            out,
            columns=["entity_id", "kind", "k", "restart", "n_blocks", "cluster", "size", "total", "centre", "error"],
        )

    return move


def _label(key, days: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
    x = _matrix(days)
    parts = []
    for m in models.itertuples():
        part = days[["entity_id", "kind", "block", "n_blocks", "date", "vector"]].copy()
        part["k"] = m.k
        part["label"] = _squares(x, _centres(m.centres, x.shape[1])).argmin(1)
        parts.append(part)
    return pd.concat(parts)


def _distances(key, mine: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """Per day of one block and per k: sums of distances to each cluster's days in another block."""
    parts = []
    for k, left in mine.groupby("k"):
        right = others[others["k"] == k]
        gaps = np.sqrt(_squares(_matrix(left), _matrix(right)))
        sums = gaps @ np.eye(k)[right["label"].to_numpy()]
        part = left[["entity_id", "kind", "date", "k", "label"]].copy()
        # A day is no distance away from itself, also after rounding.
        if key[2] == key[3]:
            own = np.take_along_axis(sums, left["label"].to_numpy()[:, None], 1)[:, 0] - gaps.diagonal()
            np.put_along_axis(sums, left["label"].to_numpy()[:, None], own[:, None], 1)
        part["sums"] = list(sums)
        parts.append(part)
    return pd.concat(parts)


# Passes over all blocks


def _add_up(arrays: str) -> Column:
    """Element-wise sum of the blocks' arrays."""
    parts = F.collect_list(arrays)
    return F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.element_at(parts, 1),
        lambda total, part: F.zip_with(total, part, lambda a, b: a + b),
    )


def _tasks(days: DataFrame, blocks: int) -> int:
    """A few blocks per task, up to the session's partitions: the work per row is far above its bytes."""
    return min(partitions(days.sparkSession), 1 + blocks // 4)


def _if_both(work, columns: str):
    """Skip a key that has rows on one side only: days are hashed to blocks, and one may stay empty."""
    names = [field.split()[0] for field in columns.split(", ")]

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return work(key, left, right) if len(left) and len(right) else pd.DataFrame(columns=names)

    return run


def _over_blocks(days: DataFrame, models: DataFrame, work, columns: str, tasks: int) -> DataFrame:
    """Bring each block together with the models of its series."""
    spread = models.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    key = [*SERIES, "block"]
    left, right = days.repartition(tasks, *key), spread.repartition(tasks, *key)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_if_both(work, columns), columns)


def _placed(vectors: DataFrame, block_days: int) -> DataFrame:
    sizes = vectors.groupBy(*SERIES).agg(F.count(F.lit(1)).cast("int").alias("n_days"))
    rows = vectors.join(sizes, SERIES).withColumn("n_blocks", F.ceil(F.col("n_days") / block_days).cast("int"))
    return rows.withColumn("block", F.pmod(F.xxhash64("date"), F.col("n_blocks")).cast("int"))


def _seeded(
    days: DataFrame, series: DataFrame, restarts: int, seed: int, passes: int, spread: bool, tasks: int
) -> DataFrame:
    states = series.select(
        *SERIES, "n_blocks", "k_max",
        F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart"),
        F.array().cast("array<double>").alias("seeds"),
    )
    columns = "entity_id string, kind string, restart int, k_max int, n_blocks int, race double, seeds array<double>"
    for _ in range(passes):
        grown = _over_blocks(days, states, _grow_seeds(seed), columns, tasks)
        states = grown.groupBy(*SERIES, "restart", "k_max", "n_blocks").agg(F.min_by("seeds", "race").alias("seeds"))
        if spread:
            states = cut_lineage(states)
    return states


def _settled(days: DataFrame, models: DataFrame, max_iter: int, spread: bool, tasks: int) -> DataFrame:
    columns = (
        "entity_id string, kind string, k int, restart int, n_blocks int, cluster int, size double, "
        "total array<double>, centre array<double>, error double"
    )
    done = []
    for _ in range(max_iter if spread else 1):
        sums = _over_blocks(days, models, _move_centres(max_iter), columns, tasks)
        clusters = sums.groupBy(*SERIES, "k", "restart", "n_blocks", "cluster").agg(
            F.sum("size").alias("size"), _add_up("total").alias("total"),
            F.first("centre").alias("old"), F.sum("error").alias("error"),
        )
        centre = F.when(F.col("size") > 0, F.transform("total", lambda v: v / F.col("size"))).otherwise(F.col("old"))
        clusters = clusters.withColumn("centre", centre).withColumn(
            "shift",
            F.aggregate(
                F.zip_with("centre", "old", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
            ),
        )
        models = clusters.groupBy(*SERIES, "k", "restart", "n_blocks").agg(
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("cluster", "centre"))), lambda c: c["centre"])).alias(
                "centres"
            ),
            F.sum("error").alias("error"),
            F.sum("shift").alias("shift"),
        )
        if not spread:
            return models
        models = cut_lineage(models)
        still = F.col("shift") <= STILL
        passed = models.agg(F.count_if(still).alias("settled"), F.count_if(~still).alias("moving")).first()
        if passed.settled:
            done.append(models.where(still))
        models = models.where(~still)
        if not passed.moving:
            break
    return reduce(DataFrame.unionByName, done, models)


def _silhouettes(labelled: DataFrame, tasks: int) -> DataFrame:
    """Mean Euclidean silhouette per (series, k), NULL below two non-empty clusters.

    Blocks meet pairwise and return one row per day with a sum per cluster; pairs
    of days are never rows.
    """
    key = [*SERIES, "mine", "other"]
    blocks = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    left = labelled.withColumn("mine", F.col("block")).withColumn("other", F.explode(blocks)).repartition(tasks, *key)
    right = labelled.withColumn("other", F.col("block")).withColumn("mine", F.explode(blocks)).repartition(tasks, *key)
    columns = "entity_id string, kind string, date date, k int, label int, sums array<double>"
    sums = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_if_both(_distances, columns), columns)
    days = sums.groupBy(*SERIES, "k", "date", "label").agg(_add_up("sums").alias("sums"))
    sizes = labelled.groupBy(*SERIES, "k", "label").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.groupBy(*SERIES, "k").agg(
        F.map_from_entries(F.collect_list(F.struct("label", "size"))).alias("sizes")
    )
    own, size = F.element_at("sums", F.col("label") + 1), F.try_element_at("sizes", F.col("label"))
    means = F.transform(
        "sums",
        lambda total, i: F.when(i != F.col("label"), total / F.try_element_at("sizes", i.cast("int"))),
    )
    days = days.join(sizes, [*SERIES, "k"]).select(
        *SERIES, "k",
        F.when(size > 1, own / (size - 1)).alias("a"),
        F.array_min(means).alias("b"),
    )
    score = (
        F.when(F.col("b").isNull(), None)
        .when(F.col("a").isNull() | (F.greatest("a", "b") == 0), 0.0)
        .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    )
    return days.groupBy(*SERIES, "k").agg(F.avg(score).alias("silhouette"))


def cluster_days(
    vectors: DataFrame,
    n_clusters: int | str = "auto",
    max_k: int = 8,
    restarts: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """(entity_id, kind, date, cluster_id, n_clusters, silhouette, vector), one row per day.

    "auto" takes the k in 2 .. min(max_k, days - 1) with the best mean
    silhouette, the smaller k on a tie, and one cluster below four days. A
    series of fewer than two days, or than a fixed k, cannot be clustered: its
    days stay, with NULL for cluster_id, n_clusters and silhouette. Series of
    one block settle in one pass; only longer ones take several.
    """
    least = 2 if n_clusters == "auto" else max(2, int(n_clusters))
    every = cut_lineage(_placed(cut_lineage(vectors), block_days))
    days, few = every.where(F.col("n_days") >= least), every.where(F.col("n_days") < least)
    series = days.select(*SERIES, "n_days", "n_blocks").distinct()
    if n_clusters == "auto":
        low = F.when(F.col("n_days") < 4, 1).otherwise(2)
        high = F.when(F.col("n_days") < 4, 1).otherwise(F.least(F.lit(max_k), F.col("n_days") - 1))
    else:
        low = high = F.lit(int(n_clusters))
    series = series.withColumn("k_min", low).withColumn("k_max", high)
    spread = F.col("n_blocks") > 1
    extent = series.agg(
        F.sum("n_blocks").alias("blocks"), F.count_if(spread).alias("long"),
        F.max(F.when(spread, F.col("k_max"))).alias("k"),
    ).first()
    tasks = _tasks(days, extent.blocks or 0)

    def fitted(some: Column, passes: int, many: bool) -> DataFrame:
        part, chosen = days.where(some), series.where(some)
        seeds = _seeded(part, chosen, restarts, seed, passes, many, tasks)
        width = F.size("seeds") / F.col("k_max")
        models = seeds.join(chosen.select(*SERIES, "k_min"), SERIES).withColumn(
            "k", F.explode(F.sequence("k_min", "k_max"))
        ).select(
            *SERIES, "k", "restart", "n_blocks",
            F.slice("seeds", F.lit(1), (width * F.col("k")).cast("int")).alias("centres"),
        )
        return _settled(part, models, max_iter, many, tasks)

    settled = fitted(~spread, 1, False)
    if extent.long:
        settled = settled.unionByName(fitted(spread, extent.k, True))
    best = settled.groupBy(*SERIES, "k", "n_blocks").agg(
        F.min_by("centres", F.struct("error", "restart")).alias("centres")
    )
    labelled = cut_lineage(
        _over_blocks(
            days, best, _label,
            "entity_id string, kind string, block int, n_blocks int, date date, vector array<double>, k int, label int",
            tasks,
        )
    )
    scores = labelled.select(*SERIES, "k").distinct().join(
        _silhouettes(labelled.where("k > 1"), tasks), [*SERIES, "k"], "left"
    )
    if n_clusters == "auto":
        better = F.struct(-F.coalesce("silhouette", F.lit(-2.0)), "k")
        scores = scores.groupBy(*SERIES).agg(F.min_by(F.struct("k", "silhouette"), better).alias("won")).select(
            *SERIES, "won.*"
        )
    chosen = labelled.join(scores, [*SERIES, "k"])
    level = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v)
    numbers = chosen.groupBy(*SERIES, "label").agg(F.count(F.lit(1)).alias("size"), F.avg(level).alias("level"))
    order = Window.partitionBy(*SERIES).orderBy(F.desc("size"), F.desc("level"), "label")
    numbers = numbers.withColumn("cluster_id", F.row_number().over(order) - 1)
    found = chosen.join(numbers.select(*SERIES, "label", "cluster_id"), [*SERIES, "label"]).select(
        *SERIES, "date", "cluster_id", F.col("k").alias("n_clusters"), "silhouette", "vector"
    )
    none = F.lit(None)
    return found.unionByName(
        few.select(
            *SERIES, "date", none.cast("int").alias("cluster_id"), none.cast("int").alias("n_clusters"),
            none.cast("double").alias("silhouette"), "vector",
        )
    )


def silhouette(labelled: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    """(entity_id, kind, k, silhouette) of days with a cluster_id from 0 on; NULL if only one cluster has days.

    k is one more than the largest cluster_id; days without one are left out.
    """
    known = labelled.where("cluster_id is not null")
    days = _placed(known.select(*SERIES, "date", "vector", F.col("cluster_id").cast("int").alias("label")), block_days)
    k = days.groupBy(*SERIES).agg((F.max("label") + 1).alias("k"))
    return _silhouettes(cut_lineage(days.join(k, SERIES)), partitions(labelled.sparkSession))


def cluster_choice(clusters: DataFrame) -> DataFrame:
    """(entity_id, kind, n_clusters, silhouette, n_days, success) per series; no success if it could not be clustered."""
    return clusters.groupBy(*SERIES, "n_clusters", "silhouette").agg(
        F.count(F.lit(1)).alias("n_days"), F.first(F.col("n_clusters").isNotNull()).alias("success")
    )


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Size, share of days, highest value of the centroid, mean spread over the intervals, and the centroid."""
    labelled = clusters.where("cluster_id is not null")
    cells = labelled.select(*SERIES, "cluster_id", F.posexplode("vector").alias("slot", "v"))
    slots = cells.groupBy(*SERIES, "cluster_id", "slot").agg(
        F.count(F.lit(1)).alias("size"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("sd")
    )
    found = slots.groupBy(*SERIES, "cluster_id").agg(
        F.max("size").alias("cluster_size"),
        F.max("mean").alias("representative_peak"),
        F.avg("sd").alias("within_cluster_variability"),
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "mean"))), lambda c: c["mean"]).alias("centroid"),
    )
    days = F.sum("cluster_size").over(Window.partitionBy(*SERIES))
    return found.select(
        *SERIES, "cluster_id", "cluster_size",
        F.bround(100 * F.col("cluster_size") / days, 1).alias("percentage_of_days"),
        "representative_peak", "within_cluster_variability", "centroid",
    )
