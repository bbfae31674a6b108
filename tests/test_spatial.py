"""Spatial operators against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbstone.operators.spatial import dbscan as D
from kerbstone.operators.spatial import kde, kmeans
from kerbstone.operators.spatial.silhouette import silhouette, whole_silhouette

RADIUS = 6371.0088


def brute(ids, lat, lon, eps, least):
    p, q = np.radians(lat), np.radians(lon)
    a = np.sin((p[:, None] - p) / 2) ** 2 + np.cos(p[:, None]) * np.cos(p) * np.sin((q[:, None] - q) / 2) ** 2
    near = 2 * RADIUS * np.arcsin(np.minimum(1, np.sqrt(a))) <= eps
    core = near.sum(1) >= least
    label, number = np.full(len(ids), -1), 0
    for i in np.argsort(ids):
        if not core[i] or label[i] >= 0:
            continue
        todo, label[i] = [i], number
        while todo:
            for k in np.flatnonzero(near[todo.pop()]):
                if label[k] < 0:
                    label[k] = number
                    if core[k]:
                        todo.append(k)
        number += 1
    return core, label


def points(spark, rng, n, clat, clon, spread):
    lat = np.clip(clat + rng.normal(0, spread, n), -90, 90)
    lon = clon + rng.normal(0, spread / max(0.01, np.cos(np.radians(clat))), n)
    lon = (lon + 180) % 360 - 180
    lat[:20], lon[:20] = lat[0], lon[0]
    ids = np.array([f"{x:05d}" for x in rng.permutation(n)])
    df = spark.createDataFrame(
        [(i, float(a), float(b)) for i, a, b in zip(ids, lat, lon)],
        "accident_id string, latitude double, longitude double",
    )
    return ids, lat, lon, df


CASES = [
    (52.0, -1.0, 0.05, 1.5, 8, 200),  # with border points and noise
    (0.0, 179.99, 0.05, 1.5, 5, 200),  # across the date line and the equator
    (89.99, 0.0, 0.05, 1.5, 5, 200),  # round the pole
    (52.0, -1.0, 0.004, 0.2, 8, 200),
]


@pytest.mark.parametrize("case", CASES)
def test_dbscan_equals_the_definition(spark, case):
    clat, clon, spread, eps, least, n = case
    ids, lat, lon, df = points(spark, np.random.default_rng(3), n, clat, clon, spread)
    core, label = brute(ids, lat, lon, eps, least)
    got = {r[0]: r[1] for r in D.dbscan(df, eps, least).collect()}
    assert [got[i] for i in ids] == list(label)
    flags = {r[0]: r[1] for r in D.core_points(df, eps, least).collect()}
    assert [flags[i] for i in ids] == list(core.astype(int))


def test_open_pairs_may_also_be_split_level_by_level(spark, monkeypatch):
    whole = D.settle
    monkeypatch.setattr(D, "settle", lambda *a, **k: whole(*a, **k, direct_pairs=0))
    ids, lat, lon, df = points(spark, np.random.default_rng(5), 150, 52.0, -1.0, 0.03)
    _, label = brute(ids, lat, lon, 1.5, 6)
    got = {r[0]: r[1] for r in D.dbscan(df, 1.5, 6).collect()}
    assert [got[i] for i in ids] == list(label)


def test_invalid_coordinates_and_too_few_points(spark):
    df = spark.createDataFrame(
        [(str(i), 50.0, 0.0) for i in range(5)] + [("x", None, 0.0), ("y", 999.0, 0.0)],
        "accident_id string, latitude double, longitude double",
    )
    got = {r[0]: r[1] for r in D.dbscan(df, 1.5, 5).collect()}
    assert got == {**{str(i): 0 for i in range(5)}, "x": -2, "y": -2}
    counts = D.cluster_counts(D.dbscan(df, 1.5, 5)).first()
    assert tuple(counts) == (1, 0, 5, 2)
    with pytest.raises(ValueError, match="usable coordinates"):
        D.dbscan(df, 1.5, 6)
    with pytest.raises(ValueError, match="6 zones"):
        kmeans.fit_kmeans(df, k=6)


def test_kmeans_labels_every_row(spark):
    rng = np.random.default_rng(0)
    _, lat, lon, df = points(spark, rng, 300, 52.0, -1.0, 0.5)
    df = df.union(spark.createDataFrame([("bad", None, 1.0)], df.schema))
    model = kmeans.fit_kmeans(df, k=5, starts=2)
    rows = kmeans.kmeans_labels(model, df).collect()
    assert len(rows) == 301
    assert {r["cluster"] for r in rows} == {-1, 0, 1, 2, 3, 4}
    assert [r["cluster"] for r in rows if r["accident_id"] == "bad"] == [-1]
    centres = np.array(model.clusterCenters())
    own = {r["accident_id"]: r["cluster"] for r in rows}
    for r in df.where("accident_id <> 'bad'").limit(50).collect():
        d = ((centres - [r["latitude"], r["longitude"]]) ** 2).sum(1)
        assert d[own[r["accident_id"]]] == pytest.approx(d.min())


def test_density_grid_equals_the_sum(spark):
    rng = np.random.default_rng(1)
    _, lat, lon, df = points(spark, rng, 250, 52.0, -1.0, 0.1)
    got = kde.density_grid(df, 2.0, 7).orderBy("gi", "gj").toPandas()
    scale = np.cos(np.radians(lat.mean())) * 111.320
    for r in got.itertuples():
        d2 = ((lat - r.lat) * 110.574) ** 2 + ((lon - r.lon) * scale) ** 2
        assert r.density == pytest.approx(np.exp(-d2 / 8).sum() / (250 * 2 * np.pi * 4), rel=1e-9, abs=1e-300)
    assert len(got) == 49
    assert got["lat"].max() == pytest.approx(lat.max())


def test_silhouette_equals_the_definition(spark):
    rng = np.random.default_rng(2)
    xy = np.concatenate([rng.normal(c, 1, (30, 2)) for c in (0, 4, 9)] + [[[50.0, 50.0]]])
    label = [0] * 30 + [1] * 30 + [2] * 30 + [3]
    df = spark.createDataFrame(
        [(str(i), float(a), float(b), k) for i, ((a, b), k) in enumerate(zip(xy, label))],
        "accident_id string, x double, y double, k int",
    )
    d = np.sqrt(((xy[:, None] - xy) ** 2).sum(2))
    label = np.array(label)
    values = []
    for i in range(len(xy)):
        own = label == label[i]
        if own.sum() == 1:
            values.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][label == o].mean() for o in set(label) - {label[i]})
        values.append((b - a) / max(a, b))
    assert silhouette(df, "x", "y", "k").first()[0] == pytest.approx(np.mean(values))
    assert silhouette(df.where("k = 0"), "x", "y", "k").first()[0] is None
    few = silhouette(df, "x", "y", "k", sample=40).first()[0]
    assert -1 <= few <= 1


def test_whole_silhouette_equals_the_definition(spark):
    rng = np.random.default_rng(5)
    label = np.append(rng.integers(0, 3, 60), 3)  # the last label has one record
    xy = rng.normal(size=(61, 2)) + label[:, None]
    values = []
    for i in range(61):
        far = ((xy - xy[i]) ** 2).sum(axis=1)
        own = label == label[i]
        a = far[own].sum() / max(own.sum() - 1, 1)
        b = min(far[label == k].mean() for k in range(4) if k != label[i])
        values.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
    rows = [(float(x), float(y), f"zone {k}") for (x, y), k in zip(xy, label)]
    df = spark.createDataFrame([*rows, (None, 1.0, "zone 9"), (1.0, 1.0, None)], "x double, y double, k string")
    assert whole_silhouette(df, "x", "y", "k").first()[0] == pytest.approx(np.mean(values))
    assert whole_silhouette(df.where("k = 'zone 0'"), "x", "y", "k").first()[0] is None
    assert whole_silhouette(df.limit(0), "x", "y", "k").first()[0] is None


def test_all_starts_in_one_pass_are_no_worse_than_separate_fits(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(5)
    middle = rng.uniform(-3, 3, (9, 2))
    xy = np.concatenate([rng.normal(m, 0.2, (60, 2)) for m in middle] + [np.tile(middle[0], (200, 1))])
    df = spark.createDataFrame([(str(i), 50 + float(a), float(b)) for i, (a, b) in enumerate(xy)],
                               "accident_id string, latitude double, longitude double")
    zones = kmeans.fit_kmeans(df, k=9, starts=10)
    gaps = ((np.column_stack([50 + xy[:, 0], xy[:, 1]])[:, None] - zones.centres) ** 2).sum(2)
    assert zones.cost == pytest.approx(gaps.min(1).sum())
    places = VectorAssembler(inputCols=["latitude", "longitude"], outputCol="p").transform(df)
    separate = min(KMeans(featuresCol="p", k=9, seed=s, maxIter=300).fit(places).summary.trainingCost for s in range(4))
    assert zones.cost <= separate * 1.001
    again = kmeans.fit_kmeans(df.repartition(5), k=9, starts=10)
    assert np.allclose(again.centres, zones.centres, atol=1e-9)


def test_silhouette_of_every_record_is_within_its_bound(spark):
    from kerbstone.operators.spatial.silhouette import bounded_silhouette

    rng = np.random.default_rng(6)
    xy = np.concatenate([rng.normal(c, s, (90, 2)) for c, s in ((0, 1), (4, 0.5), (9, 2))] + [[[50.0, 50.0]]] + [[[1.0, 1.0]]] * 20)
    label = np.array([0] * 90 + [1] * 90 + [2] * 90 + [3] + [0] * 20)
    df = spark.createDataFrame([(float(a), float(b), int(k)) for (a, b), k in zip(xy, label)], "x double, y double, k int")
    gap = np.sqrt(((xy[:, None] - xy) ** 2).sum(2))
    want = []
    for i, k in enumerate(label):
        others = [gap[i, label == c].mean() for c in set(label) if c != k]
        a = gap[i, label == k].sum() / max(1, (label == k).sum() - 1)
        want.append(0.0 if (label == k).sum() == 1 else (min(others) - a) / max(a, min(others)))
    before = 2.0
    for cells in (16, 400, 6400):
        row = bounded_silhouette(df, "x", "y", "k", cells).first()
        assert abs(row["silhouette"] - np.mean(want)) <= row["bound"] <= before
        before = row["bound"]
    assert row["bound"] < 0.03 and abs(row["silhouette"] - np.mean(want)) < 0.005
    few = df.where("k = 1")
    assert bounded_silhouette(few, "x", "y", "k").first()["silhouette"] is None
    assert bounded_silhouette(df.limit(0), "x", "y", "k").first()["silhouette"] is None
