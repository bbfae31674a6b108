"""Silhouette of a labelling, on a repeatable sample or of every record."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.operators.sampling import fixed_sample
from kerbstone.plans.cut import cut
from kerbstone.plans.skew import lookup_join, spread
from kerbstone.session import ship

ROWS_AT_ONCE = 1024
#: Cells that all labels' extents are cut into, about, and distances held at once.
MOST_CELLS, CELLS_AT_ONCE = 8192, 1 << 21


def silhouette(
    labelled: DataFrame,
    x: str,
    y: str,
    label: str,
    key: str = "accident_id",
    sample: int = C.SILHOUETTE_SAMPLE,
) -> DataFrame:
    """One row: ``silhouette`` of a sample of at most ``sample`` records.

    Null unless the sample has at least two labels and fewer labels than rows.
    The sample's size is fixed, so each task holds all of it and measures its
    own share of the rows against it; no pairs are ever rows of a table.
    """
    spark = labelled.sparkSession
    picked = fixed_sample(
        labelled.select(
            F.col(key), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
            F.col(label).cast("string").alias("label"),
        ),
        sample,
        key,
    ).select("x", "y", "label")
    held = picked.toPandas()  # at most `sample` rows
    codes, names = pd.factorize(held["label"])
    if not 2 <= len(names) <= len(held) - 1:
        return spark.createDataFrame([(None,)], "silhouette double")

    places = spark.sparkContext.broadcast(
        (held[["x", "y"]].to_numpy(float), codes, np.bincount(codes))
    )

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xy, label_of, size = places.value
        member = np.eye(len(size))[label_of]
        for batch in batches:
            i = batch["i"].to_numpy()
            gap = np.sqrt(((xy[i, None, :] - xy[None, :, :]) ** 2).sum(axis=2))
            total = gap @ member
            own = label_of[i]
            rows = np.arange(len(i))
            with np.errstate(divide="ignore", invalid="ignore"):
                inside = total[rows, own] / (size[own] - 1)
                means = total / size
                means[rows, own] = np.inf
                outside = means.min(axis=1)
                value = (outside - inside) / np.maximum(inside, outside)
            value[(size[own] == 1) | ~np.isfinite(value)] = 0.0
            yield pd.DataFrame({"value": value})

    pieces = -(-len(held) // ROWS_AT_ONCE)
    rows = spark.range(0, len(held), 1, pieces).select(F.col("id").alias("i"))
    return rows.mapInPandas(scores, "value double").agg(F.avg("value").alias("silhouette"))


def whole_silhouette(labelled: DataFrame, x: str, y: str, label: str) -> DataFrame:
    """One row: ``silhouette`` of all records by squared distances.

    Mean squared distances follow from each label's count and sums, so a few
    passes over the places and labels, which are written first, do and no sample is taken. Rows
    without a place or label do not count. Null unless there are at least two labels. One sum for each label
    goes to every task: this is for labels that are far fewer than records.
    """
    spark = labelled.sparkSession
    # written before the filter, which would work out the labels once more
    rows = cut(labelled.select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
        F.col(label).cast("string").alias("label"),
    )).dropna()
    ends = rows.agg(F.min("label").alias("least"), F.max("label").alias("most")).first()
    if ends["least"] == ends["most"]:
        return spark.createDataFrame([(None,)], "silhouette double")
    numbered = StringIndexer(inputCol="label", outputCol="number").fit(rows).transform(rows)
    places = VectorAssembler(inputCols=["x", "y"], outputCol="place").transform(numbered)
    value = ClusteringEvaluator(
        predictionCol="number", featuresCol="place", distanceMeasure="squaredEuclidean"
    ).evaluate(places)
    return spark.createDataFrame([(value,)], "silhouette double")


def bounded_silhouette(labelled: DataFrame, x: str, y: str, label: str, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row: the Euclidean ``silhouette`` of all records, and a proven ``bound`` on its error.

    Every label's extent is cut into cells, about ``most_cells`` in all (four of a
    label at least). A record's distances to the records of a cell are taken
    as that to their mean: as no record is farther from it than the cell's
    radius ``r``, the mean distance is off by ``r`` at most, and by
    ``r * r / (2 * (d - r))`` from a distance ``d`` beyond it. A cell of one place
    is exact. Equal places are one row with a weight; no pairs of records are
    ever rows of a table. Null unless there are two labels, and fewer than records.
    """
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(label).cast("string").alias("label"),
    ).dropna()
    places = cut(rows.groupBy("label", "x", "y").agg(F.count("*").cast("double").alias("n")))
    extents = cut(places.groupBy("label").agg(
        F.sum("n").alias("size"), *[f(c).alias(f"{name}_{c}") for c in "xy" for name, f in (("lo", F.min), ("hi", F.max))]))
    n_labels, n_rows = extents.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0.0))).first()
    if not 2 <= n_labels <= n_rows - 1:
        return spark.createDataFrame([(None, None)], "silhouette double, bound double")
    side = max(2, int((most_cells / n_labels) ** 0.5))

    def cell(c: str) -> Column:
        wide = F.col(f"hi_{c}") - F.col(f"lo_{c}")
        at = F.floor((F.col(c) - F.col(f"lo_{c}")) / F.when(wide > 0, wide) * side)
        return F.coalesce(F.least(at, F.lit(side - 1)), F.lit(0))

    weight, sums = F.sum("n"), {c: F.sum(F.col("n") * F.col(c)) for c in "xy"}
    cells = (
        lookup_join(places, extents, "label")
        .groupBy("label", cell("x").alias("i"), cell("y").alias("j"))
        .agg(weight.alias("n"), *[(sums[c] / weight).alias(c) for c in "xy"],
             *[f(c).alias(f"{name}_{c}") for c in "xy" for name, f in (("lo", F.min), ("hi", F.max))])
        .orderBy("label", "i", "j").toPandas()  # at most side * side rows of a label
    )
    names, starts = np.unique(cells["label"].to_numpy(str), return_index=True)
    corner = [np.maximum(cells[c] - cells[f"lo_{c}"], cells[f"hi_{c}"] - cells[c]).to_numpy() for c in "xy"]
    held = spark.sparkContext.broadcast((
        {name: k for k, name in enumerate(names)}, starts, cells[["x", "y"]].to_numpy(), cells["n"].to_numpy(),
        np.hypot(*corner), np.add.reduceat(cells["n"].to_numpy(), starts)))

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, starts, middle, weight, radius, size = held.value
        step = max(1, CELLS_AT_ONCE // len(middle))
        value = bound = 0.0
        for batch in batches:
            own_label = batch["label"].map(number).to_numpy()
            for at in range(0, len(batch), step):
                xy, own, n = batch[["x", "y"]].to_numpy()[at:at + step], own_label[at:at + step], batch["n"].to_numpy()[at:at + step]
                gap = np.sqrt(((xy[:, None, :] - middle) ** 2).sum(axis=2))
                with np.errstate(divide="ignore", invalid="ignore"):
                    off = np.where(gap > radius, np.minimum(radius, radius**2 / (2 * (gap - radius))), radius)
                    total, error = (np.add.reduceat(z * weight, starts, axis=1) for z in (gap, off))
                    i = np.arange(len(xy))
                    inside, inside_error = (z[i, own] / (size[own] - 1) for z in (total, error))
                    means, errors = total / size, error / size
                    means[i, own] = np.inf
                    nearest = means.argmin(axis=1)
                    errors[i, own] = 0.0
                    # another label may be the nearest one, but none by more than the largest error
                    outside, outside_error = means[i, nearest], errors.max(axis=1)
                    most = np.maximum(inside, outside)
                    one = (outside - inside) / most
                    spare = most - np.maximum(inside_error, outside_error)
                    wrong = np.where(spare > 0, np.minimum(2.0, (inside_error + outside_error) / spare), 2.0)
                alone = (size[own] == 1) | ~np.isfinite(one)
                value += float((np.where(alone, 0.0, one) * n).sum())
                bound += float((np.where(size[own] == 1, 0.0, np.where(np.isfinite(wrong), wrong, 2.0)) * n).sum())
        yield pd.DataFrame({"value": [value], "bound": [bound]})

    return spread(places, "label", "x", "y").mapInPandas(scores, "value double, bound double").agg(
        (F.sum("value") / n_rows).alias("silhouette"), (F.sum("bound") / n_rows).alias("bound"))
