from datetime import date, timedelta

import numpy as np
import pytest

from meterweave.operators import clusters

WIDTH = 12


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(0)
    rows, truth = [], {}
    for name, days, kinds in (("a", 60, 3), ("b", 25, 2), ("c", 3, 1), ("d", 1, 1), ("same", 6, 1)):
        base = rng.uniform(0, 100, (kinds, WIDTH))
        for i in range(days):
            noise = 0 if name == "same" else rng.normal(0, 1, WIDTH)
            day = date(2024, 1, 1) + timedelta(days=i)
            rows.append((name, "absolute", day, [float(v) for v in base[i % kinds] + noise]))
            truth[name, day] = i % kinds
    frame = spark.createDataFrame(rows, "entity_id string, kind string, date date, vector array<double>").repartition(3).cache()
    return frame, truth


def labels(df):
    return {(r.entity_id, r.date): r.cluster_id for r in df.collect()}


def silhouette(x, label):
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = gaps[i][own].sum() / (own.sum() - 1)
        b = min(gaps[i][label == other].mean() for other in set(label) - {label[i]})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


@pytest.mark.parametrize("block_days", [1024, 7])
def test_auto_finds_the_groups_in_one_or_many_blocks(made, block_days):
    vectors, truth = made
    pdf = clusters.cluster_days(vectors, block_days=block_days).toPandas()
    assert set(pdf.entity_id) == {"a", "b", "c", "d", "same"}
    # One day is too few: it stays, without a cluster.
    assert pdf[pdf.entity_id == "d"][["cluster_id", "n_clusters", "silhouette"]].isna().all(axis=None)
    for name, k in (("a", 3), ("b", 2), ("c", 1)):
        part = pdf[pdf.entity_id == name]
        assert set(part.n_clusters) == {k}
        assert len({(truth[name, d], c) for d, c in zip(part.date, part.cluster_id)}) == k
        if k > 1:
            x, label = np.stack(part.vector), part.cluster_id.to_numpy()
            assert part.silhouette.iloc[0] == pytest.approx(silhouette(x, label), abs=1e-9)


def test_same_seed_same_labels_and_sizes_add_up(spark, made):
    vectors, _ = made
    first = clusters.cluster_days(vectors, n_clusters=3)
    again = clusters.cluster_days(vectors.repartition(5), n_clusters=3)
    assert labels(first) == labels(again)
    sizes = clusters.cluster_summary(first).groupBy("entity_id").sum("cluster_size").collect()
    assert {r[0]: r[1] for r in sizes if r[0] in "ab"} == {"a": 60, "b": 25}


def test_long_and_short_series_in_one_job_agree_with_one_block(made):
    """Blocks of 30 days: one series has two blocks, the others settle in one pass."""
    vectors, _ = made
    assert labels(clusters.cluster_days(vectors, 2, block_days=30)) == labels(clusters.cluster_days(vectors, 2))


def test_a_series_below_a_fixed_k_is_reported(made):
    vectors, _ = made
    choice = {r.entity_id: r for r in clusters.cluster_choice(clusters.cluster_days(vectors, 4)).collect()}
    assert {k: r.success for k, r in choice.items()} == {"a": True, "b": True, "c": False, "d": False, "same": True}
    assert (choice["c"].n_days, choice["c"].n_clusters) == (3, None)


def test_silhouette_of_given_labels(made):
    vectors, _ = made
    fixed = clusters.cluster_days(vectors, 2)
    want = {r.entity_id: r.silhouette for r in fixed.where("cluster_id is not null").collect()}
    for block_days in (1024, 7):
        got = {r.entity_id: r.silhouette for r in clusters.silhouette(fixed, block_days).collect()}
        assert {k: got[k] for k in "abc"} == pytest.approx({k: want[k] for k in "abc"}, abs=1e-9)


def test_summary_of_one_cluster(spark, made):
    vectors, _ = made
    one = clusters.cluster_days(vectors.where("entity_id = 'b'"), n_clusters=1)
    x = np.stack(one.toPandas().vector)
    got = clusters.cluster_summary(one).first()
    assert (got.cluster_size, got.percentage_of_days) == (25, 100.0)
    assert got.representative_peak == pytest.approx(x.mean(0).max())
    assert got.within_cluster_variability == pytest.approx(x.std(0).mean())
    assert clusters.cluster_choice(one).first().silhouette is None


def test_vectors_of_complete_days_only(spark):
    from helpers import series
    from meterweave.operators import profiles

    daily = profiles.daily_profiles(series(spark, [float(v) for v in range(24)] + [1.0, None] + [1.0] * 22), 60)
    got = {r.kind: r for r in clusters.day_vectors(daily).collect()}
    assert set(got) == {"absolute", "normalized"}
    assert got["absolute"].vector == [float(v) for v in range(24)] and max(got["normalized"].vector) == 1.0
