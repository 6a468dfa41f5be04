"""K-means over the days of all series together: one model for each kind of values.

The models are Spark ML's, so that days stay distributed and a pass moves only
cluster sums. The silhouette is ClusteringEvaluator's, over squared Euclidean
distances: it needs no pairs of days, but its values are not those of the
Euclidean silhouette that `clusters` has for single series.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from meterweave.operators.clusters import SERIES
from meterweave.session import cut_lineage

FEATURES, LABEL = "features", "label"


def _comparable(vectors: DataFrame) -> DataFrame:
    """Adds `comparable`: whether a day has as many intervals as most days of its kind (the more on a tie)."""
    lengths = vectors.groupBy("kind", F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("days"))
    usual = lengths.groupBy("kind").agg(F.max_by("width", F.struct("days", "width")).alias("usual"))
    return vectors.join(usual, "kind").withColumn("comparable", F.size("vector") == F.col("usual")).drop("usual")


def _silhouette(labelled: DataFrame) -> float | None:
    """Mean silhouette over squared distances; None below two labels."""
    if labelled.select(LABEL).distinct().limit(2).count() < 2:
        return None
    evaluator = ClusteringEvaluator(featuresCol=FEATURES, predictionCol=LABEL, distanceMeasure="squaredEuclidean")
    return evaluator.evaluate(labelled)


def _best_model(days: DataFrame, k: int, restarts: int, seed: int, max_iter: int) -> KMeansModel:
    """Of several starts the model with the least squared error."""
    fits = [
        KMeans(featuresCol=FEATURES, predictionCol=LABEL, k=k, seed=seed + i, maxIter=max_iter, tol=1e-9).fit(days)
        for i in range(restarts)
    ]
    return min(fits, key=lambda model: model.summary.trainingCost)


def _numbered(labelled: DataFrame) -> DataFrame:
    """cluster_id: labels in the order of size, then level."""
    level = F.aggregate("vector", F.lit(0.0), lambda total, v: total + v)
    sizes = labelled.groupBy(LABEL).agg(F.count(F.lit(1)).alias("size"), F.avg(level).alias("level"))
    order = Window.orderBy(F.desc("size"), F.desc("level"), LABEL)
    # One row per cluster; the window sorts at most max_k of them.
    numbers = sizes.select(LABEL, (F.row_number().over(order) - 1).alias("cluster_id"))
    return labelled.join(numbers, LABEL)


def cluster_days_pooled(
    vectors: DataFrame,
    n_clusters: int | str = "auto",
    max_k: int = 8,
    restarts: int = 3,
    seed: int = 42,
    max_iter: int = 300,
) -> DataFrame:
    """(entity_id, kind, date, cluster_id, n_clusters, silhouette, vector) with clusters that all series share.

    "auto" takes the k in 2 .. min(max_k, days - 1) with the best silhouette,
    the smaller k on a tie, and one cluster below four days. Days with another
    number of intervals than most of their kind cannot be compared and, like
    days of a kind with fewer than two or than a fixed k, stay with NULL for
    cluster_id, n_clusters and silhouette.
    """
    every = cut_lineage(_comparable(vectors))
    counts = {r["kind"]: r["n"] for r in every.where("comparable").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    least = 2 if n_clusters == "auto" else max(2, int(n_clusters))
    none = F.lit(None)
    fitted = {kind: n for kind, n in counts.items() if n >= least}
    in_model = F.col("comparable") & F.col("kind").isin(*fitted)
    columns = [*SERIES, "date", "cluster_id", "n_clusters", "silhouette", "vector"]
    parts = [
        every.where(~in_model).select(
            *SERIES, "date", none.cast("int").alias("cluster_id"), none.cast("int").alias("n_clusters"),
            none.cast("double").alias("silhouette"), "vector",
        )
    ]
    for kind, n in sorted(fitted.items()):
        days = every.where(in_model & (F.col("kind") == kind)).withColumn(FEATURES, array_to_vector("vector"))
        days = days.persist(StorageLevel.MEMORY_AND_DISK)
        choices = [int(n_clusters)] if n_clusters != "auto" else list(range(2, min(max_k, n - 1) + 1)) if n >= 4 else [1]
        found: tuple[float, int, float | None, DataFrame] | None = None
        for k in choices:
            labelled = days.withColumn(LABEL, F.lit(0)) if k == 1 else _best_model(days, k, restarts, seed, max_iter).transform(days)
            score = _silhouette(labelled) if k > 1 else None
            if found is None or (score is not None and score > found[0]):
                found = (-2.0 if score is None else score, k, score, labelled)
        _, k, score, labelled = found
        numbered = _numbered(labelled).withColumn("n_clusters", F.lit(k)).withColumn("silhouette", F.lit(score).cast("double"))
        parts.append(cut_lineage(numbered.select(*columns)))
        days.unpersist()
    return reduce(DataFrame.unionByName, parts)


def pooled_choice(clusters: DataFrame) -> DataFrame:
    """(kind, n_clusters, silhouette, n_days, success) per kind; days outside the model are not counted."""
    known = F.col("cluster_id").isNotNull()
    return clusters.groupBy("kind").agg(
        F.max("n_clusters").alias("n_clusters"), F.max("silhouette").alias("silhouette"),
        F.count_if(known).alias("n_days"), (F.count_if(known) > 0).alias("success"),
    )


def pooled_silhouette(labelled: DataFrame) -> DataFrame:
    """(kind, silhouette) over squared distances of comparable days with a cluster_id; NULL below two clusters."""
    known = cut_lineage(_comparable(labelled.where("cluster_id is not null")).where("comparable"))
    days = known.select("kind", array_to_vector("vector").alias(FEATURES), F.col("cluster_id").cast("int").alias(LABEL))
    kinds = sorted(r["kind"] for r in days.select("kind").distinct().collect())
    rows = [(kind, _silhouette(days.where(F.col("kind") == kind))) for kind in kinds]
    return labelled.sparkSession.createDataFrame(rows, "kind string, silhouette double")
