"""Raw coded records to the 14-column record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import hour_of, in_range, label_of, number_or_null, trimmed
from kerbstone.plans.skew import lookup_join


def decode(raw: DataFrame) -> DataFrame:
    """Decode every code and parse every field; keeps all rows and the district code.

    All of it is one projection, so it runs inside the scan's stage.
    """
    def code(column: str) -> Column:
        return number_or_null(raw, column)

    speed = code("speed_limit")
    return raw.select(
        F.col("collision_index").alias("accident_id"),
        F.expr("try_to_date(date, 'd/M/yyyy')").alias("date"),
        hour_of("time").alias("hour"),
        trimmed("local_authority_ons_district").alias("district_code"),
        code("latitude").alias("latitude"),
        code("longitude").alias("longitude"),
        label_of(code("road_type"), C.ROAD_TYPE_CODES, C.UNKNOWN).alias("road_type"),
        label_of(code("junction_detail"), C.JUNCTION_CODES, C.UNKNOWN).alias("junction_type"),
        label_of(code("weather_conditions"), C.WEATHER_CODES, C.UNKNOWN).alias("weather"),
        label_of(code("light_conditions"), C.LIGHT_CODES, C.UNKNOWN).alias("light_condition"),
        label_of(code("road_surface_conditions"), C.SURFACE_CODES, C.UNKNOWN).alias(
            "road_surface"
        ),
        F.when(~speed.isin([float(s) for s in C.SPEED_SENTINELS]), speed).alias("speed_limit"),
        code("number_of_vehicles").alias("num_vehicles_involved"),
        label_of(code("collision_severity"), C.SEVERITY_CODES).alias("severity"),
    )


def with_district(decoded: DataFrame, codes: DataFrame) -> DataFrame:
    """Replace the district code by its name, ``Unknown`` where it has none."""
    lookup = codes.select(F.col("code").alias("district_code"), F.col("label").alias("_name"))
    return lookup_join(decoded, lookup, "district_code").select(
        *[
            F.coalesce("_name", F.lit(C.UNKNOWN)).alias("city") if c == "city" else F.col(c)
            for c in C.RECORD_COLUMNS
        ]
    )


def usable(records: DataFrame) -> DataFrame:
    """Records with a severity and a coordinate on the globe."""
    return records.where(
        F.col("severity").isNotNull() & in_range(F.col("latitude"), F.col("longitude"))
    )


def prepare(raw: DataFrame, codes: DataFrame) -> DataFrame:
    """The prepared 14-column table. Filters come before the district join."""
    return with_district(usable(decode(raw)), codes)
