"""The published segmentation is reproduced from its own features."""

import numpy as np
import pytest
from golden import GOLDEN
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from salesmart.plans import segmentation as P
from salesmart.plans import silhouette as H
from salesmart.plans import starts
from salesmart.plans.silhouette import silhouette
from salesmart.plans.starts import best_of_starts
from salesmart.workspace import settle


@pytest.fixture(scope="module")
def published(spark):
    rows = [
        (str(int(g["PharmacyID"])), *(float(g[c]) for c in P.FEATURES), g["BrandedSalesAmount"], g["GenericSalesAmount"], int(g["ActiveMonths"]))
        for g in GOLDEN
    ]
    columns = ["PharmacyID", *P.FEATURES, "BrandedSalesAmount", "GenericSalesAmount", "ActiveMonths"]
    frame = spark.createDataFrame(rows, columns)
    names = {c: F.lit("x") for c in ("PharmacyName", "LocationCode", "LocationName", "District", "Country")}
    dates = {c: F.lit("2023-06-02").cast("date") for c in ("FirstSaleDate", "LastSaleDate")}
    return frame.withColumns({**names, **dates})


@pytest.fixture(scope="module")
def model(published):
    return P.segment(published)


def test_published_totals():
    assert len(GOLDEN) == 23
    assert round(sum(g["TotalSalesAmount"] for g in GOLDEN), 2) == 18_974_403.94
    assert sum(g["NumberOfTransactions"] for g in GOLDEN) == 1_048_571


def test_ratios_follow_from_sums(spark):
    columns = ["PharmacyID", "TotalSalesAmount", "NumberOfTransactions", "ActiveMonths", "BrandedSalesAmount", "GenericSalesAmount", "TotalQuantity"]
    sums = spark.createDataFrame([tuple(float(g[c]) for c in columns) for g in GOLDEN], columns)
    got = {r.PharmacyID: r for r in P.with_ratios(sums.withColumn("LastSaleDate", F.lit("2023-06-02").cast("date"))).collect()}
    for g in GOLDEN:
        r = got[g["PharmacyID"]]
        assert r.AvgTransactionAmount == pytest.approx(g["AvgTransactionAmount"], abs=0.0051)
        assert r.MonthlySalesIntensity == pytest.approx(g["MonthlySalesIntensity"], abs=0.0051)
        assert r.BrandedSalesShare == pytest.approx(g["BrandedSalesShare"], abs=0.0001)
        assert r.GenericSalesShare == pytest.approx(g["GenericSalesShare"], abs=0.0001)
        assert r.RecencyDays == 0


def test_same_segments(model):
    got = {int(r.PharmacyID): (r.SegmentRank, r.SegmentLabel) for r in model.segments.collect()}
    assert {k: v[0] for k, v in got.items()} == {int(g["PharmacyID"]): int(g["SegmentRank"]) for g in GOLDEN}
    labels = [v[1] for v in got.values()]
    assert [labels.count(f"{n} pharmacies") for n in ("High-value", "Standard", "Low-value")] == [1, 5, 17]
    assert model.cost == pytest.approx(14.8706, abs=0.001)


def test_same_components(model):
    got = {int(r.PharmacyID): r for r in model.segments.collect()}
    for axis in ("PCA1", "PCA2"):
        assert max(abs(abs(got[int(g["PharmacyID"])][axis]) - abs(g[axis])) for g in GOLDEN) < 0.001
    explained = {r.Component: r.ExplainedVarianceRatio for r in model.pca_summary.collect()}
    assert explained["PCA1"] == pytest.approx(0.7155, abs=0.001)
    assert explained["PCA2"] == pytest.approx(0.2751, abs=0.001)


def test_summary_and_order(model):
    summary = {r.Metric: r.Value for r in model.model_summary.collect()}
    assert summary["Number of pharmacies"] == "23" and summary["Algorithm"] == "K-Means"
    assert float(summary["Silhouette standard error"]) == 0.0
    rows = model.segments.collect()
    keys = [(r.SegmentRank, -r.TotalSalesAmount) for r in rows]
    assert keys == sorted(keys)
    assert model.segments.columns == P.OUTPUT and len(P.OUTPUT) == 29
    assert len(P.for_warehouse(model.segments).columns) == 24


def test_z_scores_use_population_deviation(published):
    z = P.scaled(published).select(*(f"{c}_z" for c in P.FEATURES)).toPandas().to_numpy()
    x = published.select(*P.FEATURES).toPandas().to_numpy(dtype=float)
    sd = x.std(axis=0)
    want = np.where(sd > 1e-12, (x - x.mean(axis=0)) / np.where(sd > 1e-12, sd, 1), 0)
    np.testing.assert_allclose(np.sort(z, axis=0), np.sort(want, axis=0), atol=1e-6)


def test_too_few_entities(published):
    with pytest.raises(P.TooFewEntities):
        P.segment(published.limit(2))


def test_segments_do_not_depend_on_the_partitioning(published):
    def labels(parts):
        z = P.scaled(published.repartition(parts))
        model = P.best_kmeans(z)
        return model.cost, {r.PharmacyID: r.ClusterID for r in P.assigned(z, model).collect()}

    assert labels(1) == labels(8)


def test_best_start_against_a_plain_loop(published):
    """No start that a plain loop tries ends below the best of the batch."""
    z = settle(P.scaled(published), "scaled")
    x = np.array([list(r.z) for r in z.select("z").collect()])
    model = P.best_kmeans(z)
    own = ((x[:, None] - model.points[None]) ** 2).sum(axis=2)
    assert model.cost == pytest.approx(own.min(axis=1).sum(), abs=1e-4)
    rng, best = np.random.default_rng(1), np.inf
    for _ in range(60):
        centres = x[rng.choice(len(x), 3, replace=False)]
        for _ in range(50):
            near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            centres = np.array([x[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(3)])
        best = min(best, ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum())
    assert model.cost <= best + 1e-4


def test_many_tasks_find_the_same_centres(published, monkeypatch):
    """Partial sums that are added up by Spark, from many tasks, and by the driver, from one."""
    z = settle(P.scaled(published.repartition(6)), "scaled")
    one = P.best_kmeans(z)
    monkeypatch.setattr(starts, "TASK", 4)
    monkeypatch.setattr(starts, "FEW", 1)
    many = P.best_kmeans(z)
    assert (one.points == many.points).all() and one.cost == many.cost


def test_more_centres_than_different_stores(spark):
    z = spark.createDataFrame([(str(k), Vectors.dense([float(k % 2), 0.0])) for k in range(9)], ["PharmacyID", "z"])
    model = best_of_starts(z, "PharmacyID", "z", 4, 3, 1)
    assert model.cost == 0.0 and len(model.points) == 4


def plain_silhouette(x, label):
    total = 0.0
    for k in range(len(x)):
        away = np.sqrt(((x - x[k]) ** 2).sum(axis=1))
        own = label == label[k]
        if own.sum() > 1:
            a = away[own].sum() / (own.sum() - 1)
            b = min(away[label == c].mean() for c in set(label) if c != label[k])
            total += (b - a) / max(a, b)
    return total / len(x)


def test_published_silhouette(model, published):
    """Four decimals of a plain loop over the 23 stores."""
    segments = {r.PharmacyID: r.ClusterID for r in model.segments.collect()}
    rows = P.scaled(published).select("PharmacyID", "z").collect()
    want = plain_silhouette(np.array([list(r.z) for r in rows]), np.array([segments[r.PharmacyID] for r in rows]))
    summary = {r.Metric: r.Value for r in model.model_summary.collect()}
    assert summary["Silhouette score"] == str(round(want, 4))


@pytest.mark.parametrize("sample", [24, 60, 100_000])
def test_sampled_silhouette_is_within_its_error(spark, sample):
    rng = np.random.default_rng(3)
    label = np.array([0] * 700 + [1] * 250 + [2] * 20 + [3])
    x = rng.normal(0, 1, (len(label), 3)) + 2.0 * label[:, None] * np.array([1, 0.4, -0.3])
    rows = [(f"s{k}", Vectors.dense(v), int(c)) for k, (v, c) in enumerate(zip(x.tolist(), label, strict=True))]
    found = silhouette(spark.createDataFrame(rows, ["id", "z", "c"]).repartition(5), "id", "z", "c", sample=sample)
    want = plain_silhouette(x, label)
    if sample > 700:
        assert found.value == pytest.approx(want, abs=1e-9) and found.standard_error == 0
    else:
        assert 0 < found.standard_error < 0.05 and abs(found.value - want) < 4 * found.standard_error


def test_silhouette_of_large_clusters_is_exact(spark):
    """Clusters of more than 2,000 stores: every store is every other one's partner."""
    rng = np.random.default_rng(5)
    label = np.array([0] * 2300 + [1] * 2100 + [2] * 4 + [3])
    x = rng.normal(0, 1, (len(label), 3)) + label[:, None] * np.array([1, 0.4, -0.3])
    rows = [(f"s{k}", Vectors.dense(v), int(c)) for k, (v, c) in enumerate(zip(x.tolist(), label, strict=True))]
    found = P.euclidean_silhouette(spark.createDataFrame(rows, ["PharmacyID", "z", "ClusterID"]).repartition(5))
    assert found.value == pytest.approx(plain_silhouette(x, label), abs=1e-9)
    assert (found.standard_error, found.stores, found.clusters) == (0, len(label), 4)


@pytest.mark.parametrize(("least", "block"), [(2048, 1 << 16), (30, 1 << 16), (2048, 20), (1, 2)])
def test_silhouette_does_not_depend_on_the_blocks(spark, monkeypatch, least, block):
    """Repeated and missing keys, equal vectors, far stores that lie close together, and blocks without rows."""
    monkeypatch.setattr(H, "LEAST", least)
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "SPREAD", 5)
    monkeypatch.setattr(H, "SIDE", 8)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, (40, 2)), np.ones((9, 2)), 1e6 + rng.normal(0, 1e-3, (30, 2)), [[7.0, 7.0]]])
    label = np.concatenate([rng.integers(0, 2, 79), [5]])
    rows = [(None if k % 7 == 0 else f"s{k % 11}", Vectors.dense(v), int(c)) for k, (v, c) in enumerate(zip(x.tolist(), label, strict=True))]
    found = silhouette(spark.createDataFrame(rows, ["id", "z", "c"]).repartition(3), "id", "z", "c")
    assert found.value == pytest.approx(plain_silhouette(x, label), abs=1e-9) and found.stores == 80


def test_silhouette_of_stores_at_one_place(spark):
    rows = [(f"s{k}", Vectors.dense([0.3, -12.7]), k % 2) for k in range(20)]
    assert silhouette(spark.createDataFrame(rows, ["id", "z", "c"]), "id", "z", "c").value == 0
