"""A grid on the sphere whose cells are no wider than a given distance.

Rows are bands of latitude; each row is cut into a whole number of columns, so
that the grid closes at the date line and narrows towards the poles. Two points
of one cell are never farther apart than ``eps_km``.

Coordinates are radians here: ``phi`` is latitude, ``lam`` is longitude.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C

HALF = math.pi / 2
FULL = 2 * math.pi
ROW_SHIFT = 2**32
SLACK = 1e-9  # keeps floating-point error on the safe side of every bound

BOX = ["phi_lo", "phi_hi", "lam_lo", "lam_hi"]


def _sin2(angle: Column) -> Column:
    s = F.sin(angle / 2)
    return s * s


@dataclass(frozen=True)
class Grid:
    eps_km: float

    @property
    def angle(self) -> float:
        return self.eps_km / C.EARTH_RADIUS_KM

    @property
    def limit(self) -> float:
        """Half-chord squared of ``eps_km``: two points are near if theirs is no greater."""
        return math.sin(self.angle / 2) ** 2

    @property
    def step(self) -> float:
        # A cell of this height and width has a half-chord squared of at most
        # step^2 / 2 = limit between any two of its points.
        return math.sqrt(2) * math.sin(self.angle / 2) * (1 - SLACK)

    def _row_cosines(self, row: Column) -> tuple[Column, Column]:
        """Least and greatest cosine of latitude in a row."""
        low = row * F.lit(self.step) - HALF
        high = low + self.step
        near, far = F.least(F.abs(low), F.abs(high)), F.greatest(F.abs(low), F.abs(high))
        greatest = F.when((low <= 0) & (high >= 0), F.lit(1.0)).otherwise(F.cos(near))
        least = F.greatest(F.lit(0.0), F.cos(F.least(F.lit(HALF), far)))
        return least, greatest

    def _row_columns(self, row: Column) -> Column:
        _, greatest = self._row_cosines(row)
        return F.greatest(F.lit(1), F.ceil(greatest * (FULL / self.step))).cast("bigint")

    def place(self, df: DataFrame, latitude: str, longitude: str) -> DataFrame:
        """Add ``phi``, ``lam``, ``cell`` and the place ``u``, ``v`` (0 to 1) inside the cell."""
        df = df.withColumns(
            {
                "phi": F.radians(F.col(latitude)),
                "lam": F.radians(
                    F.when(F.col(longitude) == 180.0, F.lit(-180.0)).otherwise(F.col(longitude))
                ),
            }
        )
        df = df.withColumn("_y", (F.col("phi") + HALF) / self.step)
        df = df.withColumn("_row", F.floor("_y"))
        df = df.withColumn("_columns", self._row_columns(F.col("_row")))
        df = df.withColumn("_x", (F.col("lam") + math.pi) / FULL * F.col("_columns"))
        return df.withColumns(
            {
                "cell": F.col("_row") * F.lit(ROW_SHIFT)
                + F.pmod(F.floor("_x"), F.col("_columns")),
                "u": F.col("_y") - F.floor("_y"),
                "v": F.col("_x") - F.floor("_x"),
            }
        ).drop("_y", "_x", "_row", "_columns")

    def nearby_cells(self, df: DataFrame, name: str, prefix: str = "") -> DataFrame:
        """One row per cell that may hold points within ``eps_km`` of a row's box.

        The box is in ``phi_lo`` .. ``lam_hi`` (with ``prefix``). Cells are
        named by arithmetic alone; which of them exist is left to a join.
        """
        phi_lo, phi_hi, lam_lo, lam_hi = (F.col(prefix + c) for c in BOX)
        angle = self.angle * (1 + SLACK)
        last_row = math.floor(math.pi / self.step)
        first = F.greatest(F.lit(0), F.floor((phi_lo - angle + HALF) / self.step))
        last = F.least(F.lit(last_row), F.floor((phi_hi + angle + HALF) / self.step))
        df = df.withColumn("_row", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))
        df = df.withColumn("_columns", self._row_columns(F.col("_row")))
        row_cos, _ = self._row_cosines(F.col("_row"))
        box_cos = F.greatest(F.lit(0.0), F.least(F.cos(phi_lo), F.cos(phi_hi)))
        ratio = F.try_divide(F.lit(math.sin(angle / 2)), F.sqrt(row_cos * box_cos))
        width = F.when(ratio < 1, 2 * F.asin(ratio)).otherwise(F.lit(math.pi))
        scale = F.col("_columns") / F.lit(FULL)
        df = df.withColumn("_from", F.floor((lam_lo - width + math.pi) * scale)).withColumn(
            "_to", F.floor((lam_hi + width + math.pi) * scale)
        )
        # never more than once round
        to = F.least(F.col("_to"), F.col("_from") + F.col("_columns") - 1)
        column = F.pmod(F.col("_column"), F.col("_columns"))
        return (
            df.withColumn("_column", F.explode(F.sequence(F.col("_from"), to)))
            .withColumn(name, F.col("_row") * F.lit(ROW_SHIFT) + column)
            .drop("_row", "_columns", "_from", "_to", "_column")
        )


def box_bounds(left: str, right: str) -> tuple[Column, Column]:
    """Least and greatest half-chord squared between two boxes.

    Boxes of one point each give the same value twice: that of the two points.
    """
    a_lo, a_hi, x_lo, x_hi = (F.col(left + c) for c in BOX)
    b_lo, b_hi, y_lo, y_hi = (F.col(right + c) for c in BOX)
    phi_gap = F.greatest(F.lit(0.0), b_lo - a_hi, a_lo - b_hi)
    phi_far = F.greatest(b_hi - a_lo, a_hi - b_lo)
    lam_gap = F.greatest(F.lit(0.0), y_lo - x_hi, x_lo - y_hi)
    lam_far = F.greatest(y_hi - x_lo, x_hi - y_lo)
    lam_least = F.least(_sin2(lam_gap), _sin2(lam_far))
    lam_most = (
        F.when(lam_far <= math.pi, _sin2(lam_far))
        .when(lam_gap >= math.pi, _sin2(lam_gap))
        .otherwise(F.lit(1.0))
    )

    def cosines(lo: Column, hi: Column) -> tuple[Column, Column]:
        most = F.when((lo <= 0) & (hi >= 0), F.lit(1.0)).otherwise(
            F.greatest(F.cos(lo), F.cos(hi))
        )
        return F.least(F.cos(lo), F.cos(hi)), most

    a_least, a_most = cosines(a_lo, a_hi)
    b_least, b_most = cosines(b_lo, b_hi)
    return (
        _sin2(phi_gap) + a_least * b_least * lam_least,
        _sin2(phi_far) + a_most * b_most * lam_most,
    )


SPLIT = 4  # a box is cut into SPLIT x SPLIT smaller ones per level
LAST_LEVEL = 12


def _level_place(level: int) -> tuple[Column, Column]:
    """Name of a site's box at a level; beyond the last level, the site itself."""
    if level > LAST_LEVEL:
        return F.col("phi"), F.col("lam")
    scale = float(SPLIT**level)
    return F.floor(F.col("u") * scale).cast("double"), F.floor(F.col("v") * scale).cast("double")


def boxes(sites: DataFrame, level: int, parent: int | None = None) -> DataFrame:
    """The occupied boxes of a level: key, parent (pi, pj), name (i, j), rows and extent.

    Level 0 is the cell; ``parent`` is the level before unless given. ``sites``
    has ``key`` (its cell), ``n`` and the place.
    """
    i, j = _level_place(level)
    pi, pj = _level_place(max(level - 1, 0) if parent is None else parent)
    return (
        sites.groupBy("key", pi.alias("pi"), pj.alias("pj"), i.alias("i"), j.alias("j"))
        .agg(
            F.sum("n").alias("n"),
            F.min("phi").alias("phi_lo"),
            F.max("phi").alias("phi_hi"),
            F.min("lam").alias("lam_lo"),
            F.max("lam").alias("lam_hi"),
        )
    )


# Directions in which a cell's outermost sites are remembered, as (phi, lam) signs.
OUTWARD = [(1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (1, -1), (-1, 1), (-1, -1)]


def outermost(places: tuple[str, str] = ("u", "v")) -> Column:
    """Aggregate: the sites farthest out in each direction, as an array of points."""
    u, v = (F.col(c) for c in places)
    site = F.struct("phi", "lam")
    return F.array_distinct(
        F.array(*[F.max_by(site, u * du + v * dv) for du, dv in OUTWARD])
    )


def any_near(left: str, right: str, limit: float) -> Column:
    """Whether two arrays of points have a near pair."""

    def half_chord(p: Column, q: Column) -> Column:
        return _sin2(q["phi"] - p["phi"]) + F.cos(p["phi"]) * F.cos(q["phi"]) * _sin2(
            q["lam"] - p["lam"]
        )

    return F.exists(
        left, lambda p: F.exists(right, lambda q: half_chord(p, q) <= limit)
    )
