"""Derived time and condition features: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import weight_of


def add_features(df: DataFrame) -> DataFrame:
    """Add the six derived columns to cleaned records."""
    bucket = F.lit(C.UNKNOWN)
    for name, first, last in C.HOUR_BUCKETS:
        bucket = F.when((F.col("hour") > first - 1) & (F.col("hour") <= last), name).otherwise(
            bucket
        )
    index = sum(
        F.coalesce(weight_of(F.col(column), weights), F.lit(0))
        for column, weights in (
            ("weather", C.WEATHER_WEIGHTS),
            ("light_condition", C.LIGHT_WEIGHTS),
            ("road_surface", C.SURFACE_WEIGHTS),
        )
    )
    return df.withColumns(
        {
            "day_of_week": F.date_format("date", "EEEE"),
            "is_weekend": F.weekday("date").isin(5, 6).cast("int"),
            "is_rush_hour": F.coalesce(F.col("hour").isin(C.RUSH_HOURS), F.lit(False)).cast("int"),
            "is_night": F.coalesce(
                F.col("light_condition").startswith("Darkness"), F.lit(False)
            ).cast("int"),
            "hour_bucket": bucket,
            "weather_severity_index": index.cast("int"),
        }
    )


def model_table(featured: DataFrame, keep_id: bool = True) -> DataFrame:
    """Features, target and its index; the id stays, as rows have no position."""
    columns = (["accident_id"] if keep_id else []) + C.FEATURES + ["severity"]
    return featured.select(
        *columns, weight_of(F.col("severity"), C.SEVERITY_INDEX).alias("label")
    )
