"""Deduplication, filling and typing of prepared records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone import constants as C

FILLED_WITH_UNKNOWN = [
    "weather", "road_surface", "junction_type", "light_condition", "road_type", "city",
]
FILLED_WITH_MEDIAN = ["speed_limit", "num_vehicles_involved", "hour"]


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One row per ``accident_id``: the least by the other columns, nulls last.

    A table has no row order in Spark, so "first" is by value. The least row
    is kept while reading already, so an id with many copies costs each task
    one row. Rows without an id form one group.
    """
    rest = [c for c in df.columns if c != "accident_id"]
    ordered = F.struct(
        *[
            x
            for c in rest
            for x in (
                [F.col(c).isNull().alias(f"_no_{c}"), F.col(c)]
                if df.schema[c].nullable
                else [F.col(c)]
            )
        ]
    )
    least = df.groupBy("accident_id").agg(F.min(ordered).alias("_row"))
    return least.select(
        *["accident_id" if c == "accident_id" else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the exact, interpolated median of each column.

    The values are counted first, so what the last step holds is one entry
    per distinct value of these small code-like columns, not one per row.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS double)" for c in columns)
    counted = (
        df.select(F.expr(f"stack({len(columns)}, {pairs}) AS (name, value)"))
        .where(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count("*").alias("n"))
    )
    return counted.agg(
        *[
            F.expr(f"percentile(value, 0.5, n) FILTER (WHERE name = '{c}')").alias(c)
            for c in columns
        ]
    )


def _numeric(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.expr(f"try_cast(`{column}` AS double)")
    return F.col(column).cast("double")


def impute_missing(df: DataFrame) -> DataFrame:
    """Fill labels with ``Unknown`` and numbers with their column's median."""
    labels = [c for c in FILLED_WITH_UNKNOWN if c in df.columns]
    numbers = [c for c in FILLED_WITH_MEDIAN if c in df.columns]
    df = df.withColumns({c: _numeric(df, c) for c in numbers}).fillna(C.UNKNOWN, labels)
    if not numbers:
        return df
    middle = (
        medians(df, numbers).select(F.struct(*numbers).alias("_middle")).scalar()
    )

    def filled(c: str) -> Column:
        none = F.raise_error(F.lit(f"{c} has no number to take a median of"))
        return F.coalesce(F.col(c), middle[c], none.cast("double"))

    return df.withColumns({c: filled(c) for c in numbers})


def coerce_types(df: DataFrame) -> DataFrame:
    """Dates as dates, hour and vehicles truncated, speed rounded half to even.

    What cannot be converted fails the job rather than becoming null.
    """
    no_date = F.raise_error(F.lit("a record has no readable date"))
    return df.withColumns(
        {
            "date": F.coalesce(
                F.expr("try_cast(date AS date)"), no_date.cast("date")
            ),
            "hour": F.col("hour").cast("double").cast("int"),
            "speed_limit": F.rint(F.col("speed_limit").cast("double")).cast("int"),
            "num_vehicles_involved": F.col("num_vehicles_involved").cast("double").cast("int"),
        }
    )


def clean(df: DataFrame) -> DataFrame:
    return coerce_types(impute_missing(remove_duplicates(df)))
