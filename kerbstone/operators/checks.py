"""Structural checks of a record table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import in_range, weight_of


class DataValidationError(ValueError):
    """A record table breaks its contract."""


def bad_labels(df: DataFrame) -> DataFrame:
    """Severity labels outside the domain, with their row counts; nulls are no labels."""
    return (
        df.where(F.col("severity").isNotNull() & ~F.col("severity").isin(C.SEVERITIES))
        .groupBy("severity")
        .agg(F.count("*").alias("n"))
    )


def bad_coordinates(df: DataFrame) -> DataFrame:
    """One row: how many coordinates are off the globe or missing."""
    bad = ~in_range(F.col("latitude"), F.col("longitude"))
    return df.agg(F.count_if(bad).alias("n_bad"), F.count("*").alias("n_rows"))


def missing_classes(df: DataFrame) -> DataFrame:
    """Classes of the domain that no row has."""
    domain = df.sparkSession.createDataFrame([(s,) for s in C.SEVERITIES], "severity string")
    return domain.join(df.select("severity").distinct(), "severity", "left_anti")


def missing_classes_by(df: DataFrame, group: str) -> DataFrame:
    """For each value of ``group``, the classes of the domain that none of its rows has."""
    present = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        *[F.count_if(F.col("severity") == s).alias(s) for s in C.SEVERITIES]
    )
    classes = F.array(*[F.struct(F.lit(s).alias("severity"), F.col(s).alias("n")) for s in C.SEVERITIES])
    return present.select(group, F.inline(classes)).where(F.col("n") == 0).drop("n")


def tallies(df: DataFrame) -> DataFrame:
    """One row with all that the checks need, from one pass over ``df``.

    ``n_rows, n_labels_bad, bad_label, n_coordinates_bad, n_dates_bad,
    n_weights_bad``, and ``n_<class>`` of each class. Labels outside the
    vocabulary are counted as rows; one of them is shown.
    """
    severity = F.col("severity")
    bad = severity.isNotNull() & ~severity.isin(C.SEVERITIES)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(bad).alias("n_labels_bad"),
        F.min(F.when(bad, severity)).alias("bad_label"),
        F.count_if(~in_range(F.col("latitude"), F.col("longitude"))).alias("n_coordinates_bad"),
        F.count_if(F.col("date").isNull()).alias("n_dates_bad"),
        F.count_if(weight_of(severity, C.RISK_WEIGHTS).isNull()).alias("n_weights_bad"),
        *[F.count_if(severity == s).alias(f"n_{s.lower()}") for s in C.SEVERITIES],
    )


def require_columns(df: DataFrame) -> None:
    absent = sorted(set(C.RECORD_COLUMNS) - set(df.columns))
    if absent:
        raise DataValidationError(f"columns that every record needs are absent: {absent}")


def require_tallies(counts: Row, dates: bool = True, classes: bool = True) -> None:
    """Raise for the first fault that :func:`tallies` has counted."""
    if not counts["n_rows"]:
        raise DataValidationError("there are no rows to check")
    if counts["n_labels_bad"]:
        raise DataValidationError(
            f"severity has {counts['n_labels_bad']} rows with labels outside its vocabulary, such as {counts['bad_label']!r}"
        )
    if counts["n_coordinates_bad"]:
        raise DataValidationError(f"{counts['n_coordinates_bad']} rows lie outside the range of latitudes and longitudes")
    gone = sorted(s for s in C.SEVERITIES if not counts[f"n_{s.lower()}"])
    if classes and gone:
        raise DataValidationError(f"no record is {' or '.join(gone)}")
    if dates and counts["n_dates_bad"]:
        raise DataValidationError(f"{counts['n_dates_bad']} rows have no readable date")


def quarantined(df: DataFrame) -> DataFrame:
    """The rows that a check objects to, with ``reasons``."""
    severity = F.col("severity")
    faults = {
        "label": severity.isNotNull() & ~severity.isin(C.SEVERITIES),
        "coordinates": ~in_range(F.col("latitude"), F.col("longitude")),
        "date": F.col("date").isNull(),
    }
    reasons = F.array_compact(F.array(*[F.when(fault, F.lit(name)) for name, fault in faults.items()]))
    return df.withColumn("reasons", reasons).where(F.size("reasons") > 0)


def validate(df: DataFrame) -> None:
    """Raise unless ``df`` has the columns, rows, labels and coordinates it must have."""
    require_columns(df)
    require_tallies(tallies(df).first(), dates=False, classes=False)


def require_all_classes(df: DataFrame) -> None:
    gone = [r["severity"] for r in missing_classes(df).orderBy("severity").collect()]
    if gone:
        raise DataValidationError(f"no record is {' or '.join(gone)}")


def require_weights(df: DataFrame) -> None:
    """Raise if some row's severity has no risk weight."""
    n = df.where(weight_of(F.col("severity"), C.RISK_WEIGHTS).isNull()).count()
    if n:
        raise DataValidationError(f"{n} rows have a severity without a risk weight.")


def require_dates(df: DataFrame) -> None:
    """Raise if some row has no readable date."""
    n = df.where(F.col("date").isNull()).count()
    if n:
        raise DataValidationError(f"{n} rows have no readable date")
