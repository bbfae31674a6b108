"""Profiles and exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import in_range, round_even_places, trimmed
from kerbstone.operators.decode import decode

LABEL_COLUMNS = [
    "city", "road_type", "junction_type", "weather", "light_condition", "road_surface",
]


def _unpivot(one_row: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return one_row.select(F.expr(f"stack({len(columns)}, {pairs}) AS ({name}, {value})"))


def profile(df: DataFrame) -> DataFrame:
    """Rows, full duplicates, % missing per column, class shares and date range.

    Rows are counted by their whole content first; everything else is read off
    those counts. Columns: section, name, value, text.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    one = counted.agg(
        F.sum("_n").alias("n_rows"),
        F.sum(F.col("_n") - 1).alias("n_duplicate_rows"),
        *[
            F.sum(F.when(F.col(c).isNull(), F.col("_n")).otherwise(0)).alias(f"no_{c}")
            for c in df.columns
        ],
        F.min("date").cast("string").alias("first_date"),
        F.max("date").cast("string").alias("last_date"),
    )

    def line(section: str, name: str, value, text=None):
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(name).alias("name"),
            (F.lit(None) if value is None else value).cast("double").alias("value"),
            (F.lit(None) if text is None else F.col(text)).cast("string").alias("text"),
        )

    lines = [
        line("table", "n_rows", F.col("n_rows")),
        line("table", "n_duplicate_rows", F.col("n_duplicate_rows")),
        *[
            line(
                "missing_pct",
                c,
                round_even_places(F.col(f"no_{c}") / F.col("n_rows") * 100, 2),
            )
            for c in df.columns
        ],
        line("date_range", "first", None, "first_date"),
        line("date_range", "last", None, "last_date"),
    ]
    shares = (
        counted.where(F.col("severity").isNotNull())
        .groupBy("severity")
        .agg(F.sum("_n").alias("n"))
    )
    total = shares.agg(F.sum("n").alias("t")).scalar()
    share_lines = shares.select(
        F.lit("severity_share").alias("section"),
        F.col("severity").alias("name"),
        round_even_places(F.col("n") / total, 4).alias("value"),
        F.lit(None).cast("string").alias("text"),
    )
    return one.select(F.inline(F.array(*lines))).unionByName(share_lines)


def value_counts(df: DataFrame, column: str, nulls: bool = True) -> DataFrame:
    """Count and share of each value of ``column``."""
    rows = df if nulls else df.where(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, 6))


def null_counts(df: DataFrame) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _unpivot(one, df.columns, "column_name", "n_null")


def unknown_counts(df: DataFrame) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c) == C.UNKNOWN).alias(c) for c in LABEL_COLUMNS])
    return _unpivot(one, LABEL_COLUMNS, "column_name", "n_unknown")


def extent(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("latitude").alias("min_lat"),
        F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"),
        F.max("longitude").alias("max_lon"),
        F.min("date").cast("string").alias("first_date"),
        F.max("date").cast("string").alias("last_date"),
    )


def stage_counts(raw: DataFrame) -> DataFrame:
    """Rows left after each filter of the decode and after deduplication."""
    decoded = decode(raw)
    present = (
        F.col("severity").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
    )
    usable = F.col("severity").isNotNull() & in_range(F.col("latitude"), F.col("longitude"))
    # One row per id carries the row counts along, so the table is read once.
    by_id = decoded.groupBy("accident_id").agg(
        F.count("*").alias("raw"),
        F.count_if(present).alias("present"),
        F.count_if(usable).alias("usable"),
    )
    one = by_id.agg(
        F.sum("raw").alias("raw"),
        F.sum("present").alias("present"),
        F.sum("usable").alias("usable"),
        F.count_if(F.col("usable") > 0).alias("deduplicated"),
    )
    return _unpivot(one, ["raw", "present", "usable", "deduplicated"], "stage", "n")


def hourly(df: DataFrame) -> DataFrame:
    return df.groupBy("hour").agg(F.count("*").alias("n"))


def fatal_rate_by_conditions(df: DataFrame) -> DataFrame:
    """Share of Fatal by weather (rows) and light (columns)."""
    fatal = F.when(F.col("severity") == "Fatal", 1).otherwise(0)
    return (
        df.groupBy("weather")
        .pivot("light_condition", C.LIGHT_CONDITIONS)
        .agg(F.round(F.avg(fatal), 6))
    )


def severity_by_speed(df: DataFrame) -> DataFrame:
    """Severity shares for each speed limit."""
    counts = df.groupBy("speed_limit").agg(
        F.count("severity").alias("_n"),
        *[F.count_if(F.col("severity") == s).alias(s) for s in C.SEVERITIES],
    )
    return counts.select(
        "speed_limit", *[F.round(F.col(s) / F.col("_n"), 6).alias(s) for s in C.SEVERITIES]
    )


def district_column(columns: list[str]) -> str | None:
    """The first recognised district column, in any letter case."""
    by_name = {c.strip().lower(): c for c in columns}
    for name in ("city", "district", "local_authority_district"):
        if name in by_name:
            return by_name[name]
    return None


def districts(df: DataFrame) -> DataFrame:
    """Usable district names, sorted. Reads that one column only."""
    column = district_column(df.columns)
    if column is None:
        raise ValueError(f"no recognised district column among {df.columns}")
    name = trimmed(F.col(column).cast("string"))
    return (
        df.select(name.alias("district"))
        .where((F.col("district") != "") & ~F.lower("district").isin("unknown", "nan", "none"))
        .distinct()
        .orderBy("district")
    )
