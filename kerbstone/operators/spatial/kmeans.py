"""Broad geographic zones by k-means on degrees, all starts in the same passes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import in_range
from kerbstone.plans.cut import cut
from kerbstone.session import ship

INVALID = -1
MOST_CENTROIDS = 1_000
WRITTEN_OUT = 64
#: A start has settled when none of its centres moves farther, in degrees.
TOLERANCE = 1e-4
MOST_ROUNDS = 300


class Zones(NamedTuple):
    """The centres of the best start, and the sum of squared distances to them."""

    centres: np.ndarray
    cost: float

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def table(self, places: DataFrame) -> DataFrame:
        rows = [(i, float(lat), float(lon)) for i, (lat, lon) in enumerate(self.centres)]
        return places.sparkSession.createDataFrame(rows, "cluster int, centre_lat double, centre_lon double")


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.column_stack([batch.column(c).to_numpy() for c in ("latitude", "longitude")]), batch.column("n").to_numpy()


def _squares(xy: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((xy[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def _drawn(xy: np.ndarray, number: int) -> np.ndarray:
    """A repeatable number in (0, 1) for each place."""
    mixed = xy[:, 0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ xy[:, 1].view(np.uint64)
    mixed = mixed + np.uint64(number % (1 << 32) * 0xD1B54A32D192ED03 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return ((mixed >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def _next_centres(places: DataFrame, chosen: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """One more first centre for every start, far places being likelier, in one pass.

    Each place draws a number to the power of one over its weight times its
    squared distance; the largest wins, so tasks send one candidate per start.
    """
    step = len(chosen[0])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(-np.inf, 0.0, 0.0)] * len(chosen)
        for batch in batches:
            xy, n = _numbers(batch)
            if not len(xy):
                continue
            for start, centres in enumerate(chosen):
                weight = n * (_squares(xy, centres).min(axis=1) if step else 1.0)
                with np.errstate(divide="ignore"):
                    key = np.log(_drawn(np.ascontiguousarray(xy.T).T, seed + 1009 * start + step)) / weight
                at = int(np.argmax(key))
                best[start] = max(best[start], (float(key[at]), *xy[at].tolist()))
        columns = [pa.array(x) for x in zip(*[(s, *b) for s, b in enumerate(best)])]
        yield pa.RecordBatch.from_arrays(columns, names=["start", "key", "lat", "lon"])

    rows = places.mapInArrow(candidates, "start bigint, key double, lat double, lon double").groupBy("start").agg(
        F.max(F.struct("key", "lat", "lon")).alias("b")).select("start", "b.*").collect()
    found = {r["start"]: [r["lat"], r["lon"]] for r in rows}
    return [np.vstack([c, [found[s]]]) for s, c in enumerate(chosen)]


def _sums(places: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each start: rows ``weight, sum of lat, sum of lon, cost`` by centre, in one pass for all of them."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {start: np.zeros((len(c), 4)) for start, c in centres.items()}
        for batch in batches:
            xy, n = _numbers(batch)
            for start, c in centres.items():
                gaps = _squares(xy, c)
                own = gaps.argmin(axis=1)
                parts = (n, n * xy[:, 0], n * xy[:, 1], n * gaps[np.arange(len(xy)), own])
                for k, part in enumerate(parts):
                    total[start][:, k] += np.bincount(own, part, len(c))
        rows = [(start, i, *row) for start, t in total.items() for i, row in enumerate(t.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["start", "i", "n", "x", "y", "cost"])

    rows = places.mapInArrow(add_up, "start bigint, i bigint, n double, x double, y double, cost double").groupBy(
        "start", "i").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "cost")]).collect()
    out = {start: np.zeros((len(c), 4)) for start, c in centres.items()}
    for r in rows:
        out[r["start"]][r["i"]] = [r["n"], r["x"], r["y"], r["cost"]]
    return out


def fit_kmeans(
    points: DataFrame,
    k: int = C.KMEANS_K,
    starts: int = C.KMEANS_STARTS,
    seed: int = C.SEED,
) -> Zones:
    """The best of several starts on all usable coordinates.

    Equal coordinates become one weighted row before the iterations begin. A
    pass serves all starts that have not settled: a task sends one row for each
    of their centres. A centre without places stays where it is.
    """
    ship(points.sparkSession)
    valid = points.where(in_range(F.col("latitude"), F.col("longitude")))
    places = cut(valid.groupBy(
        F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"),
    ).agg(F.count("*").cast("double").alias("n")))
    total = places.agg(F.sum("n")).first()[0] or 0
    if total < k:
        raise ValueError(f"{k} zones need as many usable coordinates, there are {total:.0f}")
    chosen = [np.zeros((0, 2)) for _ in range(starts)]
    for _ in range(k):
        chosen = _next_centres(places, chosen, seed)
    live = dict(enumerate(chosen))
    settled: dict[int, np.ndarray] = {}
    for _ in range(MOST_ROUNDS):
        if not live:
            break
        for start, sums in _sums(places, live).items():
            old = live[start]
            weight = sums[:, :1]
            new = np.where(weight > 0, sums[:, 1:3] / np.maximum(weight, 1e-300), old)
            live[start] = new
            if ((new - old) ** 2).sum(axis=1).max() <= TOLERANCE**2:
                settled[start] = live.pop(start)
    settled |= live
    costs = {start: float(sums[:, 3].sum()) for start, sums in _sums(places, settled).items()}
    best = min(costs, key=lambda start: (costs[start], start))
    return Zones(settled[best], costs[best])


def kmeans_labels(
    model: Zones,
    points: DataFrame,
    id_column: str = "accident_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, cluster)`` of every record with its columns ``keep``, -1 without a usable coordinate."""
    valid = in_range(F.col("latitude"), F.col("longitude"))
    kept = points.withColumn("_kept", F.struct(F.lit(0).alias("_"), *keep))
    placed = nearest_centroid(kept, model.table(points))
    return placed.select(
        id_column,
        *[F.col(f"_kept.{c}").alias(c) for c in keep],
        F.when(valid, F.col("cluster")).otherwise(INVALID).alias("cluster"),
    )


def nearest_centroid(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """Add ``cluster``: the centroid least far in degrees, the lower number on ties.

    ``centroids`` has ``cluster``, ``centre_lat`` and ``centre_lon``; they are
    carried to the rows as one array, so there may not be many of them.
    """
    held = centroids.select("cluster", "centre_lat", "centre_lon").limit(MOST_CENTROIDS + 1).collect()
    if len(held) > MOST_CENTROIDS:
        raise ValueError("too many centroids for a scan per row")
    lat, lon = F.col("latitude"), F.col("longitude")

    def ranked(c) -> Column:
        d_lat, d_lon = lat - c["centre_lat"], lon - c["centre_lon"]
        return F.struct((d_lat * d_lat + d_lon * d_lon).alias("d"), c["cluster"].alias("cluster"))

    centres = [F.struct(*[F.lit(r[c]).alias(c) for c in ("cluster", "centre_lat", "centre_lon")]) for r in held]
    # few are written out, as a lambda is not compiled
    distances = F.array(*map(ranked, centres)) if len(held) <= WRITTEN_OUT else F.transform(F.array(*centres), ranked)
    return points.withColumn("cluster", F.array_min(distances)["cluster"])
