"""Smoothed risk score of road, junction, weather and time segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import bounded_score, risk_band, round_even_places, weight_of
from kerbstone.plans.cut import cut


def risk_lookup(featured: DataFrame) -> DataFrame:
    """One row per segment with its smoothed 0-100 score and band.

    The rows are aggregated once and the segments, which are few, written. The mean weight of the whole table is summed
    up from the segments, including those without a full key, which are left
    out of the result.
    """
    weight = weight_of(F.col("severity"), C.RISK_WEIGHTS)
    segments = cut(featured.groupBy(*C.SEGMENT_KEYS).agg(
        F.count("*").alias("n_accidents"),
        F.coalesce(F.sum(weight), F.lit(0)).alias("weighted_sum"),
        F.count(weight).alias("_n_weighted"),
        F.count_if(F.col("severity") == "Fatal").alias("fatal_count"),
        F.count_if(F.col("severity") == "Serious").alias("serious_count"),
    ))
    mean = segments.agg(
        (F.sum("weighted_sum").cast("double") / F.sum("_n_weighted")).alias("mean")
    ).scalar()
    k = C.RISK_SMOOTHING
    smoothed = (F.col("weighted_sum") + k * mean) / (F.col("n_accidents") + k)
    score = smoothed / max(C.RISK_WEIGHTS.values()) * 100
    return (
        segments.dropna(subset=C.SEGMENT_KEYS)
        .drop("_n_weighted")
        .withColumn("smoothed_avg_weight", smoothed)
        .withColumn("risk_score", round_even_places(bounded_score(score), 2))
        .withColumn("risk_level", risk_band(F.col("risk_score")))
    )


def top_segments(lookup: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` highest scores; equal scores in key order."""
    return lookup.orderBy(
        F.col("risk_score").desc(), *[F.col(k).asc_nulls_last() for k in C.SEGMENT_KEYS]
    ).limit(n)
