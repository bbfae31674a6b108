"""Lookup joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup of at most this many rows may be sent to every executor.
BROADCAST_ROWS = 100_000
# A key is heavy when it holds at least one row in this many, or in the number of
# partitions if those are more; there can be no more heavy keys than that.
HEAVY_SHARE = 1_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that plus one."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows out before each becomes many.

    The number of partitions is given, because adaptive execution would size
    them by the few rows there are now.
    """
    spark = df.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(wanted, spark.sparkContext.defaultParallelism), *keys)


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    key: str,
    broadcast_rows: int = BROADCAST_ROWS,
    heavy_share: int | None = None,
) -> DataFrame:
    """Left join of ``big`` to ``lookup``, which has one row per ``key``.

    A lookup of checked size is broadcast. A larger one is shuffled, except
    for the keys that hold at least ``1/heavy_share`` of ``big``: there are at
    most ``heavy_share`` of those, so their lookup rows are broadcast, and the
    rows that found theirs are spread evenly instead of meeting in one task.
    """
    if heavy_share is None:
        partitions = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        heavy_share = max(HEAVY_SHARE, partitions)
    if fits_broadcast(lookup, broadcast_rows):
        return big.join(F.broadcast(lookup), key, "left")

    values = [c for c in lookup.columns if c != key]
    counts = big.groupBy(key).agg(F.count("*").alias("_n"))
    least = counts.agg(F.sum("_n") / F.lit(heavy_share)).scalar()
    heavy = counts.where((F.col("_n") >= least) & F.col(key).isNotNull()).select(key)
    heavy_rows = lookup.join(F.broadcast(heavy), key, "left_semi").select(
        F.col(key).alias("_heavy"), F.struct(*values).alias("_heavy_row")
    )
    spread = F.when(F.col("_heavy").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*big.columns), F.lit(4096)) + 1
    )
    marked = big.join(
        F.broadcast(heavy_rows), F.col(key) == F.col("_heavy"), "left"
    ).withColumn("_spread", spread)
    rest = lookup.select(
        F.col(key).alias("_key"),
        F.lit(0).cast("bigint").alias("_zero"),
        F.struct(*values).alias("_row"),
    )
    joined = marked.join(
        rest, (F.col(key) == F.col("_key")) & (F.col("_spread") == F.col("_zero")), "left"
    )
    found = F.coalesce("_heavy_row", "_row")
    return joined.select(*big.columns, *[found[c].alias(c) for c in values])
