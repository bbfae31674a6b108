"""Stored results: cleaned records, lookups, hotspots, metrics and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    """Parquet, and a CSV export where one is wanted."""
    df.write.mode("overwrite").parquet(path)
    if csv_path is not None:
        df.sparkSession.read.parquet(path).write.mode("overwrite").csv(csv_path, header=True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_records(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    """Records partitioned by year.

    The rebalance hint gives each file about the same size: a year with many
    records is split over several tasks, and small years share one.
    """
    years = df.withColumn("year", F.year("date")).hint("rebalance", "year")
    years.write.mode("overwrite").partitionBy("year").parquet(path)
    if csv_path is not None:
        read_records(df.sparkSession, path).write.mode("overwrite").csv(csv_path, header=True)


def read_records(spark: SparkSession, path: str, years: list[int] | None = None) -> DataFrame:
    """Stored records; ``years`` prunes the folders that are read."""
    df = spark.read.parquet(path)
    if years is not None:
        df = df.where(F.col("year").isin(years))
    return df.drop("year")


def metrics_document(
    spark: SparkSession,
    dataset: str,
    records: DataFrame,
    results: DataFrame,
    best_model: str,
    cv: DataFrame,
    hotspot: DataFrame,
) -> DataFrame:
    """One row holding all metrics: counts, one struct per model, folds and places.

    Every part is one row per model, fold or run, never one per record.
    """
    models = results.agg(
        F.sort_array(F.collect_list(F.struct("model", *[c for c in results.columns if c != "model"])))
        .alias("severity")
    )
    folds = cv.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("fold", "fatal_recall"))),
            lambda f: f["fatal_recall"],
        ).alias("severity_cv_fatal_recall")
    )
    return spark.range(1).select(
        F.lit(dataset).alias("dataset"),
        records.agg(F.count("*")).scalar().alias("dataset_records"),
        models.scalar().alias("severity"),
        F.lit(best_model).alias("severity_best_model"),
        folds.scalar().alias("severity_cv_fatal_recall"),
        hotspot.select(F.struct(*hotspot.columns).alias("hotspot")).scalar().alias("hotspot"),
    )


def write_metrics(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").json(path)  # one row


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def model_rows(document: DataFrame) -> DataFrame:
    """The stored metrics as one row per model, best Fatal recall first."""
    return document.select(F.inline("severity")).orderBy(
        F.coalesce("fatal_recall", F.lit(0.0)).desc(), F.col("macro_f1").desc(), "model"
    )


def save_model(spark: SparkSession, model: PipelineModel, name: str, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark.range(1).select(F.lit(name).alias("model_name")).coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> tuple[str, PipelineModel]:
    name = spark.read.json(f"{path}/about").first()["model_name"]
    return name, PipelineModel.load(f"{path}/model")
