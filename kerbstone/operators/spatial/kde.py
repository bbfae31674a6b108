"""Kernel density of the records on a grid over their extent."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import in_range


def density_grid(
    points: DataFrame,
    bandwidth_km: float = C.KDE_BANDWIDTH_KM,
    grid_size: int = C.KDE_GRID_SIZE,
) -> DataFrame:
    """``(gi, gj, lat, lon, density)``: exact Gaussian density at each grid node.

    A Gaussian of a locally flat map is the product of one in x and one in y.
    A batch of records is therefore two narrow matrices, records by grid rows
    and records by grid columns, and their product adds the batch to all nodes
    at once. Each task sends on one grid, whatever the number of its records.
    """
    valid = points.where(in_range(F.col("latitude"), F.col("longitude"))).select(
        "latitude", "longitude"
    )
    n, mean_lat, lat0, lat1, lon0, lon1 = valid.agg(
        F.count("*"), F.avg("latitude"), F.min("latitude"), F.max("latitude"),
        F.min("longitude"), F.max("longitude"),
    ).first()
    if not n:
        raise ValueError("a density needs at least one usable coordinate")

    km_lon = math.cos(math.radians(mean_lat)) * C.KM_PER_DEGREE_LON
    lats = np.linspace(lat0, lat1, grid_size)
    lons = np.linspace(lon0, lon1, grid_size)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((grid_size, grid_size))
        for batch in batches:
            lat = batch["latitude"].to_numpy()[:, None]
            lon = batch["longitude"].to_numpy()[:, None]
            north = np.exp(-(((lat - lats) * C.KM_PER_DEGREE_LAT / bandwidth_km) ** 2) / 2)
            east = np.exp(-(((lon - lons) * km_lon / bandwidth_km) ** 2) / 2)
            total += north.T @ east
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"gi": i.ravel(), "gj": j.ravel(), "part": total.ravel()})

    whole = valid.mapInPandas(add_up, "gi int, gj int, part double")
    steps = max(grid_size - 1, 1)
    return whole.groupBy("gi", "gj").agg(
        (F.sum("part") / (n * 2 * math.pi * bandwidth_km**2)).alias("density")
    ).select(
        "gi",
        "gj",
        (F.lit(lat0) + F.col("gi") * ((lat1 - lat0) / steps)).alias("lat"),
        (F.lit(lon0) + F.col("gj") * ((lon1 - lon0) / steps)).alias("lon"),
        "density",
    )
