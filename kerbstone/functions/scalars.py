"""Column expressions shared by the operators."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbstone import constants as C


def number_or_null(df: DataFrame, column: str) -> Column:
    """A number, null where the text is none. Mentions the column once only, so
    that a filter on it stays small when it is pushed below the projection.

    The cast also takes Java's type suffixes and hexadecimal digits, which are
    not numbers in a data file; those letters are made unreadable first.
    """
    if isinstance(df.schema[column].dataType, T.StringType):
        text = F.translate(F.col(column), "dDfFxX", "??????")
        value = text.try_cast("double")
    else:
        value = F.col(column).cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def label_of(code: Column, labels: dict[int, str], default: str | None = None) -> Column:
    """Label of a numeric code, so that ``1`` and ``1.0`` decode alike."""
    pairs = chain.from_iterable((F.lit(float(k)), F.lit(v)) for k, v in labels.items())
    # adding 0.0 turns a negative zero into a plain one
    found = F.create_map(*pairs)[code + F.lit(0.0)]
    return found if default is None else F.coalesce(found, F.lit(default))


def weight_of(label: Column, weights: dict[str, int]) -> Column:
    """Integer weight of a label, null where it has none."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(weights.items())])[label]


def hour_of(column: str) -> Column:
    """Hour of a ``HH:MM`` text, null unless it is a time of day."""
    hour = F.regexp_extract(F.col(column), r"^(\d|[01]\d|2[0-3]):[0-5]?\d$", 1)
    return hour.try_cast("int")


def round_even_places(value: Column, places: int) -> Column:
    """Scale, round half to even, scale back."""
    factor = F.lit(float(10**places))
    return F.rint(value * factor) / factor


def in_range(latitude: Column, longitude: Column) -> Column:
    """Whether a coordinate is on the globe; a missing one is not."""
    ok = (F.abs(latitude) <= 90.0) & (F.abs(longitude) <= 180.0)
    return F.coalesce(ok, F.lit(False))


def risk_band(score: Column) -> Column:
    """Band of a risk score; a score outside all bands is in the last one."""
    band = F.lit(C.RISK_BANDS[-1][0])
    for name, low, high in reversed(C.RISK_BANDS[:-1]):
        band = F.when((score >= low) & (score < high), F.lit(name)).otherwise(band)
    return band


def bounded_score(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))


def most_likely(probabilities: Column) -> Column:
    """Index of the largest probability, the first one on ties."""
    ranked = F.transform(
        probabilities, lambda p, i: F.struct(p.alias("p"), (-i).alias("place"))
    )
    return (-F.array_max(ranked)["place"]).cast("int")


def recall_oriented(probabilities: Column, threshold: float = C.FATAL_THRESHOLD) -> Column:
    """Fatal once its probability reaches the threshold, else the most likely class."""
    return F.when(probabilities[C.FATAL_INDEX] >= threshold, F.lit(C.FATAL_INDEX)).otherwise(
        most_likely(probabilities)
    )


def severity_of(index: Column) -> Column:
    return F.array(*[F.lit(s) for s in C.SEVERITIES])[index.cast("int")]


def hash_rank_key(column: str, seed: int = C.SEED) -> Column:
    """A repeatable pseudo-random text for ranking rows, equal in any engine with md5."""
    return F.md5(F.concat(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(f":{seed}")))
def trimmed(text: Column | str) -> Column:
    """``text`` without white space of any kind at its ends, no-break spaces included."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
