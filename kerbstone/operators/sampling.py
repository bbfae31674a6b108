"""Repeatable samples, splits and folds from hash ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import hash_rank_key
from kerbstone.plans.order import grouped_index

PREFIX = 4  # hexadecimal digits: 65,536 hash ranges


def fixed_sample(df: DataFrame, n: int, key: str = "accident_id", seed: int = C.SEED) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those with the least hash.

    Counting the rows per hash prefix first tells how far up the order the
    sample reaches, so only about ``n`` rows are sorted, whatever the table's
    size.
    """
    ranked = df.withColumn("_rank", hash_rank_key(key, seed))
    prefix = F.substring("_rank", 1, PREFIX)
    counts = ranked.groupBy(prefix.alias("_prefix")).agg(F.count("*").alias("_n"))
    # at most 16 ** PREFIX rows reach this window
    so_far = F.sum("_n").over(Window.orderBy("_prefix"))
    reach = (
        counts.withColumn("_total", so_far)
        .where(F.col("_total") >= n)
        .agg(F.min("_prefix").alias("_reach"))
        .scalar()
    )
    return (
        ranked.where(prefix <= F.coalesce(reach, F.lit("f" * PREFIX)))
        .orderBy("_rank", F.col(key).asc_nulls_last())
        .limit(n)
        .drop("_rank")
    )


def class_rank(df: DataFrame, label: str, key: str = "accident_id", seed: int = C.SEED) -> DataFrame:
    """Add ``class_rank``: 1, 2, ... by hash inside each class."""
    return (
        grouped_index(
            df.withColumn("_rank", hash_rank_key(key, seed)),
            label,
            [F.col("_rank"), F.col(key).asc_nulls_last()],
            "class_rank",
        ).drop("_rank")
    )


def _with_class_size(df: DataFrame, label: str) -> DataFrame:
    # class_rank has checked that there are few classes
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.max("class_rank").alias("class_size"))
    return df.join(F.broadcast(sizes), F.col(label).eqNullSafe(F.col("_class"))).drop("_class")


def stratified_split(
    df: DataFrame,
    label: str = "severity",
    share: float = C.TEST_SHARE,
    key: str = "accident_id",
    seed: int = C.SEED,
) -> DataFrame:
    """Add ``is_test``: the first ``round(share * size)`` ranks of each class."""
    ranked = _with_class_size(class_rank(df, label, key, seed), label)
    return ranked.withColumn(
        "n_test", F.floor(F.col("class_size") * F.lit(share) + 0.5)
    ).withColumn("is_test", (F.col("class_rank") <= F.col("n_test")).cast("int"))


def stratified_folds(
    df: DataFrame,
    label: str = "severity",
    folds: int = C.FOLDS,
    key: str = "accident_id",
    seed: int = C.SEED,
) -> DataFrame:
    """Add ``fold`` 0..folds-1, dealt out in rank order inside each class."""
    ranked = _with_class_size(class_rank(df, label, key, seed), label)
    return ranked.withColumn("fold", ((F.col("class_rank") - 1) % folds).cast("int"))
