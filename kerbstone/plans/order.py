"""Global order statistics without a single-partition window.

A window with no partition key, or with one that a third of all rows share,
sorts in one task. Here the rows are range-partitioned by the order columns
and numbered inside each range; only one total per range (at most the number
of shuffle partitions) is added up centrally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstone.plans.cut import cut
from kerbstone.plans.skew import fits_broadcast


def _ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """Sort globally and write down each row's range and place in it."""
    ordered = df.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().alias("_place"),
    )
    # The range of a row is only stable once it is written.
    return cut(ordered)


def global_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... in the global order of ``order``."""
    placed = _ranges(df, order)
    sizes = placed.groupBy("_range").agg(
        F.count("*").alias("_n"), F.min("_place").alias("_first")
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    # one row per range: bounded by spark.sql.shuffle.partitions
    return placed.join(F.broadcast(starts), "_range").select(
        *df.columns, (F.col("_start") + F.col("_place") - F.col("_first") + 1).alias(name)
    )


def running_totals(
    df: DataFrame, order: list[Column], totals: dict[str, str]
) -> DataFrame:
    """Add, for each ``{new: column}``, the sum of ``column`` over all earlier rows."""
    placed = _ranges(df, order)
    sizes = placed.groupBy("_range").agg(
        *[F.sum(column).alias(f"_sum_{new}") for new, column in totals.items()]
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range",
        *[
            F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_start_{new}")
            for new in totals
        ],
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.join(F.broadcast(starts), "_range")
        .select(
            *df.columns,
            *[
                (
                    F.col(f"_start_{new}")
                    + F.coalesce(F.sum(column).over(inside), F.lit(0))
                ).alias(new)
                for new, column in totals.items()
            ],
        )
    )


def grouped_index(
    df: DataFrame, group: str, order: list[Column], name: str
) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... inside each value of ``group``.

    Groups may be as large as the table: the sort is global, and a group's
    first index (one row per group) is taken off afterwards. Few groups are
    broadcast; many are joined by key, where adaptive execution splits a large one.
    """
    numbered = global_index(df, [F.col(group).asc_nulls_last(), *order], "_index")
    firsts = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_index").alias("_base"))
    if fits_broadcast(firsts):
        firsts = F.broadcast(firsts)
    return numbered.join(firsts, F.col(group).eqNullSafe(F.col("_group"))).select(*df.columns, (F.col("_index") - F.col("_base") + 1).alias(name))
