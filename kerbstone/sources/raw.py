"""Readers for the raw coded records, the code list and the prepared table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone import constants as C
from kerbstone.functions.scalars import trimmed

RAW_COLUMNS = [
    "collision_index", "date", "time", "collision_severity", "road_type",
    "junction_detail", "weather_conditions", "light_conditions",
    "road_surface_conditions", "local_authority_ons_district", "latitude",
    "longitude", "speed_limit", "number_of_vehicles",
]

PREPARED_SCHEMA = T.StructType(
    [
        T.StructField("accident_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.DoubleType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("road_type", T.StringType()),
        T.StructField("junction_type", T.StringType()),
        T.StructField("weather", T.StringType()),
        T.StructField("light_condition", T.StringType()),
        T.StructField("road_surface", T.StringType()),
        T.StructField("speed_limit", T.DoubleType()),
        T.StructField("num_vehicles_involved", T.DoubleType()),
        T.StructField("severity", T.StringType()),
    ]
)

# Spellings a delimited file uses for a missing value.
MISSING_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def _blank_to_null(df: DataFrame) -> DataFrame:
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            F.when(~F.col(c).isin(MISSING_SPELLINGS), F.col(c)).alias(c) if c in strings else c
            for c in df.columns
        ]
    )


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw coded records from one or several CSV files, columns found by header name.

    Every column is read as text, so identifiers keep their leading zeros;
    columns outside the contract are never parsed further.
    """
    parts = []
    for header, files in _by_header(spark, path).items():
        absent = sorted(set(RAW_COLUMNS) - set(header))
        if absent:
            raise ValueError(f"{files[0]} has no column {', '.join(absent)}")
        rows = spark.read.csv(files, header=True, inferSchema=False, mode="PERMISSIVE")
        parts.append(rows.select(*RAW_COLUMNS))
    return _blank_to_null(reduce(DataFrame.unionByName, parts))


def _by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of ``path`` by their header line.

    Spark applies the first file's header to all files by position, so files
    whose columns come in another order must be read apart.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        header = tuple(spark.read.csv(file, header=True, inferSchema=False).columns)
        found.setdefault(header, []).append(file)
    if not found:
        raise ValueError(f"no files in {path}")
    return found


def read_code_list(
    spark: SparkSession, path: str, field: str = C.DISTRICT_FIELD
) -> DataFrame:
    """One field of the published code list as ``(code, label)``.

    The file has the columns ``field name``, ``code/format`` and ``label``.
    A repeated code takes its last line, in file order.
    """
    rows = spark.read.csv(path, header=True, inferSchema=False).select(
        F.col("`field name`").alias("field_name"),
        F.col("`code/format`").alias("code"),
        F.col("label"),
        F.monotonically_increasing_id().alias("line"),
    )
    return code_list(rows, field, order="line")


def code_list(rows: DataFrame, field: str, order: str | None = None) -> DataFrame:
    """``(code, label)`` of ``field``, trimmed, one row per code.

    ``order`` names the column that says which of several rows is the last;
    without it the greatest label is taken, so that the choice is repeatable.
    """
    wanted = rows.where(F.col("field_name") == field).select(
        trimmed("code").alias("code"),
        trimmed("label").alias("label"),
        F.col(order or "label").alias("_order"),
    )
    return wanted.groupBy("code").agg(F.max_by("label", "_order").alias("label"))


def read_prepared_csv(spark: SparkSession, path: str) -> DataFrame:
    """Prepared 14-column records, with header names deciding the order."""
    known = {f.name: f for f in PREPARED_SCHEMA.fields}
    parts = []
    for header, files in _by_header(spark, path).items():
        schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
        parts.append(spark.read.schema(schema).csv(files, header=True))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _blank_to_null(whole)
