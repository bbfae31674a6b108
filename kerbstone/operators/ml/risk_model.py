"""A regressor that scores segments the lookup has few or no records of."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import bounded_score, risk_band, round_even_places


def fit_risk_model(lookup: DataFrame, trees: int = 200, seed: int = C.SEED) -> PipelineModel:
    """Boosted trees over the one-hot segment keys; well-observed segments weigh more."""
    keys = C.SEGMENT_KEYS
    stages = [
        StringIndexer(
            inputCols=keys, outputCols=[f"index__{k}" for k in keys],
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"index__{k}" for k in keys],
            outputCols=[f"hot__{k}" for k in keys], dropLast=True,
        ),
        VectorAssembler(inputCols=[f"hot__{k}" for k in keys], outputCol="features"),
        GBTRegressor(
            labelCol="risk_score", weightCol="weight", maxIter=trees, maxDepth=3,
            stepSize=0.08, seed=seed, checkpointInterval=10,
        ),
    ]
    rows = lookup.select(*keys, "risk_score", F.log1p("n_accidents").alias("weight"))
    return Pipeline(stages=stages).fit(rows)


def score_segments(model: PipelineModel, segments: DataFrame) -> DataFrame:
    """``risk_score`` and ``risk_level`` of every segment. The band is that of the
    score before it is rounded."""
    bounded = bounded_score(F.col("prediction"))
    return model.transform(segments.select(*C.SEGMENT_KEYS)).select(
        *C.SEGMENT_KEYS,
        round_even_places(bounded, 2).alias("risk_score"),
        risk_band(bounded).alias("risk_level"),
    )


def all_segments(spark: SparkSession) -> DataFrame:
    """Every combination of the vocabularies: a table of fixed size."""
    rows = spark.range(1)
    values = {
        "road_type": C.ROAD_TYPES,
        "junction_type": C.JUNCTION_TYPES,
        "weather": C.WEATHER_CONDITIONS,
        "hour_bucket": [name for name, _, _ in C.HOUR_BUCKETS],
        "is_weekend": [0, 1],
    }
    for column, options in values.items():
        rows = rows.withColumn(column, F.explode(F.array(*[F.lit(o) for o in options])))
    return rows.drop("id")
