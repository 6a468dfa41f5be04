from datetime import date, timedelta

import numpy as np
import pytest

from meterweave.operators import features, pooled

SCHEMA = "entity_id string, kind string, date date, vector array<double>"


@pytest.fixture(scope="module")
def made(spark):
    """Three shapes of day that the series of a kind share, one odd length, one kind with a single day."""
    rng = np.random.default_rng(4)
    shapes = rng.uniform(0, 50, (3, 8)) + np.array([[0], [200], [500]])
    rows = []
    for i in range(36):
        day = date(2024, 5, 1) + timedelta(days=i // 4)
        rows.append((f"e{i % 4}", "absolute", day, [float(v) for v in shapes[(i // 5) % 3] + rng.normal(0, 1, 8)]))
    rows += [("e9", "absolute", date(2024, 5, 1), [1.0] * 16), ("e9", "normalized", date(2024, 5, 1), [1.0] * 8)]
    truth = {(r[0], r[2]): (i // 5) % 3 for i, r in enumerate(rows[:36])}
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows, truth


def squared_silhouette(x, label):
    gaps = ((x[:, None] - x[None]) ** 2).sum(-1)
    scores = []
    for i in range(len(x)):
        own = label == label[i]
        a = gaps[i][own].sum() / (own.sum() - 1)
        b = min(gaps[i][label == other].mean() for other in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


def test_series_share_clusters_and_odd_days_stay(made):
    vectors, rows, truth = made
    got = pooled.cluster_days_pooled(vectors, max_k=5)
    pdf = got.toPandas()
    assert len(pdf) == len(rows)
    odd = pdf[(pdf.entity_id == "e9")]
    assert len(odd) == 2 and odd[["cluster_id", "n_clusters", "silhouette"]].isna().all(axis=None)
    part = pdf[pdf.entity_id != "e9"]
    assert set(part.n_clusters) == {3}
    assert len({(truth[e, d], c) for e, d, c in zip(part.entity_id, part.date, part.cluster_id, strict=True)}) == 3
    sizes = part.groupby("cluster_id").size()
    assert list(sizes) == sorted(sizes, reverse=True)
    x, label = np.stack(part.vector), part.cluster_id.to_numpy()
    assert part.silhouette.iloc[0] == pytest.approx(squared_silhouette(x, label), abs=1e-9)
    choice = {r.kind: (r.n_clusters, r.n_days, r.success) for r in pooled.pooled_choice(got).collect()}
    assert choice == {"absolute": (3, 36, True), "normalized": (None, 0, False)}


def test_few_days_and_a_fixed_number(spark, made):
    vectors, _, _ = made
    three = vectors.where("entity_id = 'e0'").limit(3)
    assert {(r.cluster_id, r.n_clusters, r.silhouette) for r in pooled.cluster_days_pooled(three).collect()} == {(0, 1, None)}
    assert {r.cluster_id for r in pooled.cluster_days_pooled(three, n_clusters=4).collect()} == {None}
    assert pooled.cluster_days_pooled(vectors.limit(0)).isEmpty()
    one = spark.createDataFrame([("a", "absolute", date(2024, 5, 1), [1.0], 0), ("b", "absolute", date(2024, 5, 1), [2.0], 0)], SCHEMA + ", cluster_id int")
    assert pooled.pooled_silhouette(one).first().silhouette is None


def test_entities_take_temperature_from_the_best_covered_member(spark):
    day = date(2024, 5, 1)
    stamp = lambda h: np.datetime64(f"2024-05-01T{h:02d}:00").astype("datetime64[us]").item()
    rows = [("a", stamp(1), 10.0), ("a", stamp(2), None), ("b", stamp(1), 40.0), ("b", stamp(2), 60.0), ("c", stamp(1), 7.0), ("c", stamp(2), 9.0), ("d", stamp(1), None)]
    seen = spark.createDataFrame(rows, "meter_id string, timestamp timestamp_ntz, temperature_f double")
    members = spark.createDataFrame([("G", "a"), ("G", "c"), ("G", "b"), ("G", "b"), ("a", "a"), ("H", "d"), ("H", "x")], "entity_id string, meter_id string")
    got = {r.entity_id: (r.date, r.mean_temperature_f, r.temperature_range_f) for r in features.entity_temperature(seen, members).collect()}
    assert got == {"G": (day, 50.0, 20.0), "a": (day, 10.0, 0.0)}
