"""Density clustering of every record, under great-circle distance.

The neighbour join of the textbook method emits all pairs of a dense place.
Here the points are first put into cells no wider than ``eps``. A cell with
``min_samples`` points makes them all core points of one cluster without a
single distance; distances are computed for points of thin cells, and between
neighbouring cells only until it is known whether any two core points are
near. Both questions are answered by comparing boxes, whose least and greatest
distances settle most cases; only what remains open is split into smaller
boxes, down to single sites. Clusters are connected components of cells.

The result does not depend on any of this: it equals the plain definition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import in_range
from kerbstone.operators.spatial.grid import (
    BOX, LAST_LEVEL, Grid, any_near, box_bounds, boxes, outermost,
)
from kerbstone.plans.components import connected_components
from kerbstone.plans.cut import cut
from kerbstone.plans.order import global_index
from kerbstone.plans.skew import fits_broadcast, lookup_join

NOISE = -1
NOT_CLUSTERED = -2


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _split(pairs: DataFrame, side: str, children: DataFrame) -> DataFrame:
    """Replace one side's box by the occupied boxes inside it."""
    children = _renamed(children, "c_")
    kept = [c for c in pairs.columns if not c.startswith(side) or c == f"{side}key"]
    match = (
        (F.col(f"{side}key") == F.col("c_key"))
        & (F.col(f"{side}i") == F.col("c_pi"))
        & (F.col(f"{side}j") == F.col("c_pj"))
    )
    return pairs.join(children, match).select(
        *kept, *[F.col(f"c_{c}").alias(side + c) for c in ["i", "j", "n", *BOX]]
    )


def _of_open_cells(sites: DataFrame, rest: DataFrame, side: str) -> DataFrame:
    """Without the sites of settled cells, where the list of open ones is short.

    They are left out while reading, so a few open pairs do not shuffle the
    whole table again.
    """
    keys = rest.select(F.col(f"{side}key").alias("key")).distinct()
    if fits_broadcast(keys):
        return sites.join(F.broadcast(keys), "key", "left_semi")
    return sites


# Open pairs of boxes holding no more than this many pairs of points between
# them are compared point by point instead of being split further.
DIRECT_PAIRS = 5_000_000


def settle(
    pairs: DataFrame,
    group: list[str],
    limit: float,
    right: DataFrame,
    left: DataFrame | None = None,
    direct_pairs: int = DIRECT_PAIRS,
) -> DataFrame:
    """The groups of box pairs that have at least ``need`` near points.

    A pair has a left box (``l_``), a right box (``r_``), both with their
    number of points, and its group's ``need``. Points of a right box count
    when the two boxes are near as a whole; pairs that may or may not be are
    split, the right box into the boxes of ``right`` and the left one into
    those of ``left`` unless it is a point. A group whose answer is known is
    not looked at again.
    """
    least, most = box_bounds("l_", "r_")
    hits = []
    level = 0
    while True:
        judged = cut(
            pairs.withColumns({"_least": least, "_most": most})
            .where(F.col("_least") <= limit)
            .withColumn("_near", F.col("_most") <= limit)
            .drop("_least", "_most")
        )
        groups = judged.groupBy(*group).agg(
            F.min("need").alias("need"),
            F.sum(F.when(F.col("_near"), F.col("r_n")).otherwise(0)).alias("_sure"),
            F.sum("r_n").alias("_possible"),
        )
        hits.append(groups.where(F.col("_sure") >= F.col("need")).select(*group))
        still_open = groups.where(
            (F.col("_sure") < F.col("need")) & (F.col("_possible") >= F.col("need"))
        ).select(*group, (F.col("need") - F.col("_sure")).alias("need"))
        rest = judged.where(~F.col("_near")).drop("need", "_near").join(still_open, group)
        product = F.col("l_n").cast("double") * F.col("r_n")
        n_open, work = rest.agg(F.count("*"), F.sum(product)).first()
        if not n_open:
            return reduce(DataFrame.union, hits)
        before, level = level, level + 1
        if work <= direct_pairs:
            level = LAST_LEVEL + 1
        pairs = _split(rest, "r_", boxes(_of_open_cells(right, rest, "r_"), level, before))
        if left is not None:
            pairs = _split(pairs, "l_", boxes(_of_open_cells(left, rest, "l_"), level, before))


def sites_of(points: DataFrame, grid: Grid, id_column: str) -> DataFrame:
    """Distinct coordinates with their number of points and least id."""
    return grid.place(
        points.where(in_range(F.col("latitude"), F.col("longitude")))
        .groupBy("latitude", "longitude")
        .agg(F.count("*").alias("n"), F.min(id_column).alias("first_id")),
        "latitude",
        "longitude",
    ).select("cell", "phi", "lam", "u", "v", "n", "first_id")


def thin_cell_sites(sites: DataFrame, min_samples: int) -> DataFrame:
    """The sites of cells with fewer than ``min_samples`` points, with that number.

    ``min_samples`` sites of a cell are enough to tell that it is not thin, so
    each task passes on no more than that of any cell, however full it is.
    """
    few = Window.partitionBy("cell").orderBy("phi", "lam")
    whole = Window.partitionBy("cell")
    return (
        sites.withColumn("_place", F.row_number().over(few))
        .where(F.col("_place") <= min_samples)
        .withColumn("n_cell", F.sum("n").over(whole))
        .where(F.col("n_cell") < min_samples)
        .drop("_place")
    )


def _point_box(df: DataFrame) -> DataFrame:
    """The left side of a pair made of one site."""
    return df.select(
        F.col("cell").alias("l_key"),
        F.col("phi").alias("l_phi_lo"),
        F.col("phi").alias("l_phi_hi"),
        F.col("lam").alias("l_lam_lo"),
        F.col("lam").alias("l_lam_hi"),
        F.lit(1).cast("bigint").alias("l_n"),
        "need",
    )


SITE = ["l_key", "l_phi_lo", "l_lam_lo"]


def core_thin_sites(
    sites: DataFrame, thin: DataFrame, grid: Grid, min_samples: int
) -> DataFrame:
    """The core sites among those of thin cells."""
    tree = sites.withColumnRenamed("cell", "key")
    probes = _point_box(thin.withColumn("need", F.lit(min_samples) - F.col("n_cell")))
    cells = _renamed(boxes(tree, 0).drop("pi", "pj"), "r_")
    pairs = (
        grid.nearby_cells(probes, "_cell", "l_")
        .where(F.col("_cell") != F.col("l_key"))
        .join(cells, F.col("_cell") == F.col("r_key"))
        .drop("_cell")
    )
    hits = settle(pairs, SITE, grid.limit, right=tree)
    return thin.join(
        hits.select(
            F.col("l_key").alias("cell"), F.col("l_phi_lo").alias("phi"), F.col("l_lam_lo").alias("lam")
        ),
        ["cell", "phi", "lam"],
        "left_semi",
    )


def core_points(
    points: DataFrame,
    eps_km: float = C.DBSCAN_EPS_KM,
    min_samples: int = C.DBSCAN_MIN_SAMPLES,
    id_column: str = "accident_id",
) -> DataFrame:
    """``(id, is_core)`` of every record with a coordinate: has it ``min_samples``
    records within ``eps_km``, itself included?"""
    grid = Grid(eps_km)
    sites = cut(sites_of(points, grid, id_column))
    thin = cut(thin_cell_sites(sites, min_samples))
    core = core_thin_sites(sites, thin, grid, min_samples).select(
        "cell", "phi", "lam", F.lit(True).alias("core")
    )
    flags = (
        thin.select("cell", "phi", "lam")
        .join(core, ["cell", "phi", "lam"], "left")
        .groupBy("cell")
        .agg(F.collect_list(F.struct("phi", "lam", "core")).alias("sites"))
    )
    placed = grid.place(
        points.where(in_range(F.col("latitude"), F.col("longitude"))), "latitude", "longitude"
    ).select(id_column, "cell", "phi", "lam")
    here = F.filter(
        "sites", lambda s: (s["phi"] == F.col("phi")) & (s["lam"] == F.col("lam"))
    )
    # a point of a cell that is not thin is a core point
    return lookup_join(placed, cut(flags), "cell").select(
        id_column,
        (F.col("sites").isNull() | F.coalesce(F.get(here, F.lit(0))["core"], F.lit(False)))
        .cast("int")
        .alias("is_core"),
    )


def dbscan(
    points: DataFrame,
    eps_km: float = C.DBSCAN_EPS_KM,
    min_samples: int = C.DBSCAN_MIN_SAMPLES,
    id_column: str = "accident_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, cluster)`` of every record of ``points``, with its columns ``keep``.

    ``min_samples`` counts the point itself. Clusters are numbered from 0 by
    their least core id; a border point joins the lowest-numbered cluster it
    is near to. Noise is -1, a record without a usable coordinate -2.
    """
    grid = Grid(eps_km)
    sites = cut(sites_of(points, grid, id_column))
    total = sites.agg(F.sum("n")).first()[0] or 0
    if total < min_samples:
        raise ValueError(f"density clusters need {min_samples} usable coordinates, there are {total}")

    thin = cut(thin_cell_sites(sites, min_samples))
    thin_core = cut(core_thin_sites(sites, thin, grid, min_samples))

    # Core cells. A thin cell's key is negative: its boxes hold core sites only.
    tree = sites.withColumn("key", F.col("cell")).unionByName(
        thin_core.drop("n_cell").withColumn("key", -1 - F.col("cell"))
    )
    extent = [
        F.sum("n").alias("n"),
        F.min("phi").alias("phi_lo"),
        F.max("phi").alias("phi_hi"),
        F.min("lam").alias("lam_lo"),
        F.max("lam").alias("lam_hi"),
        F.min("first_id").alias("first_id"),
        outermost().alias("outer"),
    ]
    nodes = cut(
        tree.groupBy("cell", "key")
        .agg(*extent)
        .where((F.col("key") < 0) | (F.col("n") >= min_samples))
        .withColumns({"i": F.lit(0.0), "j": F.lit(0.0)})
    )
    # Neighbouring cells whose outermost sites are near need no further look.
    near = any_near("l_outer", "r_outer", grid.limit)
    found = nodes.drop("first_id")
    candidates = cut(
        grid.nearby_cells(
            _renamed(found, "l_").withColumn("need", F.lit(1).cast("bigint")), "_cell", "l_"
        )
        .where(F.col("_cell") > F.col("l_cell"))
        .join(_renamed(found, "r_"), F.col("_cell") == F.col("r_cell"))
        .withColumn("linked", near)
        .drop("_cell", "l_cell", "r_cell", "l_outer", "r_outer")
    )
    linked = candidates.where("linked").select("l_key", "r_key")
    unclear = candidates.where("not linked").drop("linked")
    edges = linked.union(
        settle(unclear, ["l_key", "r_key"], grid.limit, right=tree, left=tree)
    )
    components = connected_components(
        nodes, edges.select(F.col("l_key").alias("a"), F.col("r_key").alias("b"))
    )

    # Number the components by their least core id.
    held = components.join(nodes.select("key", "first_id"), "key")
    firsts = held.groupBy("component").agg(F.min("first_id").alias("first_id"))
    numbers = global_index(firsts, [F.col("first_id").asc_nulls_last()], "number").select(
        "component", (F.col("number") - 1).cast("int").alias("cluster")
    )
    clusters = cut(lookup_join(components, numbers, "component").select("key", "cluster"))

    # Border sites take the lowest cluster among the core cells they touch.
    outside = thin.join(thin_core, ["cell", "phi", "lam"], "left_anti")
    probes = _point_box(outside.withColumn("need", F.lit(1).cast("bigint")))
    border_pairs = (
        grid.nearby_cells(probes, "_cell", "l_")
        .join(
            _renamed(nodes.drop("first_id", "outer"), "r_"), F.col("_cell") == F.col("r_cell")
        )
        .drop("_cell", "r_cell")
    )
    touches = settle(border_pairs, [*SITE, "r_key"], grid.limit, right=tree)
    border = (
        touches.join(clusters, F.col("r_key") == F.col("key"))
        .groupBy(
            F.col("l_key").alias("cell"),
            F.col("l_phi_lo").alias("phi"),
            F.col("l_lam_lo").alias("lam"),
        )
        .agg(F.min("cluster").alias("cluster"))
    )

    # One row per cell that has clustered points: a number for a full cell, a
    # list of fewer than min_samples sites for a thin one.
    whole = clusters.where(F.col("key") >= 0).select(
        F.col("key").alias("cell"), F.col("cluster").alias("cell_cluster")
    )
    members = (
        thin_core.select("cell", "phi", "lam", (-1 - F.col("cell")).alias("key"))
        .join(clusters, "key")
        .select("cell", "phi", "lam", "cluster")
        .unionByName(border)
        .groupBy("cell")
        .agg(F.collect_list(F.struct("phi", "lam", "cluster")).alias("sites"))
    )
    lookup = cut(whole.unionByName(members, allowMissingColumns=True))

    valid = in_range(F.col("latitude"), F.col("longitude"))
    placed = grid.place(points, "latitude", "longitude").select(
        id_column, *keep, F.when(valid, F.col("cell")).alias("cell"), "phi", "lam"
    )
    here = F.filter(
        "sites", lambda s: (s["phi"] == F.col("phi")) & (s["lam"] == F.col("lam"))
    )
    return lookup_join(placed, lookup, "cell").select(
        id_column,
        *keep,
        F.when(F.col("cell").isNull(), F.lit(NOT_CLUSTERED))
        .otherwise(
            F.coalesce("cell_cluster", F.get(here, F.lit(0))["cluster"], F.lit(NOISE))
        )
        .alias("cluster"),
    )


def cluster_counts(labels: DataFrame) -> DataFrame:
    """One row: clusters, noise, clustered and not clustered records."""
    one = labels.groupBy("cluster").agg(F.count("*").alias("n"))
    label, n = F.col("cluster"), F.col("n")

    def total(which):
        return F.coalesce(F.sum(F.when(which, n)), F.lit(0))

    return one.agg(
        F.count_if(label >= 0).alias("n_clusters"),
        total(label == NOISE).alias("n_noise"),
        total(label >= 0).alias("n_members"),
        total(label == NOT_CLUSTERED).alias("n_not_clustered"),
    )
