"""The whole job: raw coded records in, tables, models and metrics out.

    python -m kerbstone.run --raw 'records/*.csv' --codes codes.csv --out /shared/out
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.operators import checks, clean, decode, features, hotspots, profile, risk
from kerbstone.operators.explain.attribution import background_sample
from kerbstone.operators.ml import risk_model, training
from kerbstone.operators.ml.classifiers import CANDIDATES, Presets
from kerbstone.operators.spatial import dbscan, kmeans
from kerbstone.operators.spatial.silhouette import silhouette, whole_silhouette
from kerbstone.plans.cut import cut
from kerbstone.session import ship
from kerbstone.sources import artifacts, raw


def _spots(spark: SparkSession, records: DataFrame, out: str) -> DataFrame:
    """Zones, clusters and the hotspot table; one row of their figures."""
    # Labels travel with the records: a join by id would lose those without one.
    kept = tuple(c for c in records.columns if c != "accident_id")
    zoned = kmeans.kmeans_labels(kmeans.fit_kmeans(records), records, keep=kept)
    zoned = cut(zoned.withColumnRenamed("cluster", "zone"))
    placed = cut(dbscan.dbscan(zoned, keep=(*kept, "zone")))
    artifacts.write_table(
        placed.select("accident_id", F.col("zone").alias("cluster")), f"{out}/zones"
    )
    artifacts.write_table(placed.select("accident_id", "cluster"), f"{out}/clusters")
    ranked = hotspots.rank_hotspots(placed)
    artifacts.write_table(ranked, f"{out}/hotspots", f"{out}/hotspots_csv")
    stored = artifacts.read_table(spark, f"{out}/hotspots")
    if stored.isEmpty():
        raise ValueError("no cluster is left to rank")

    members = placed.where(F.col("cluster") >= 0).withColumns(
        {"phi": F.radians("latitude"), "lam": F.radians("longitude")}
    )
    counts = dbscan.cluster_counts(artifacts.read_table(spark, f"{out}/clusters")).first()
    zone_score = silhouette(placed.where(F.col("zone") >= 0), "latitude", "longitude", "zone").first()[0]
    cluster_score = silhouette(members, "phi", "lam", "cluster").first()[0]
    zone_score_all = whole_silhouette(placed.where(F.col("zone") >= 0), "latitude", "longitude", "zone").first()[0]
    cluster_score_all = whole_silhouette(members, "phi", "lam", "cluster").first()[0]
    return spark.createDataFrame(
        [
            (
                C.KMEANS_K, zone_score, counts["n_clusters"], counts["n_noise"],
                counts["n_members"] + counts["n_noise"], counts["n_not_clustered"],
                cluster_score, stored.count(), zone_score_all, cluster_score_all,
            )
        ],
        "kmeans_k int, kmeans_silhouette double, dbscan_n_clusters bigint, "
        "dbscan_n_noise bigint, dbscan_n_clustered bigint, dbscan_n_not_clustered bigint, "
        "dbscan_silhouette double, hotspot_records_ranked bigint, "
        # of every record, by squared distances; the other two are of a fixed sample
        "kmeans_silhouette_all double, dbscan_silhouette_all double",
    )


def run(
    spark: SparkSession,
    raw_records: DataFrame,
    codes: DataFrame,
    out: str,
    dataset: str = "road collisions",
    presets: Presets = Presets(),
    names: list[str] = CANDIDATES,
    risk_trees: int = 200,
) -> DataFrame:
    """Run every step, store every result under ``out``, return the metrics document.

    Each step reads what the one before has stored, so lost executors cost a
    step's tasks and never the steps before it.
    """
    ship(spark)
    artifacts.write_table(decode.prepare(raw_records, codes), f"{out}/prepared")
    prepared = artifacts.read_table(spark, f"{out}/prepared")
    checks.require_columns(prepared)
    # one pass for all checks; what they object to is kept beside the results
    counts = checks.tallies(prepared).first()
    if counts["n_labels_bad"] or counts["n_coordinates_bad"] or counts["n_dates_bad"]:
        artifacts.write_table(checks.quarantined(prepared), f"{out}/quarantine")
    checks.require_tallies(counts)
    artifacts.write_table(profile.profile(prepared), f"{out}/profile")

    artifacts.write_records(clean.clean(prepared), f"{out}/cleaned")
    records = artifacts.read_records(spark, f"{out}/cleaned").select(*C.RECORD_COLUMNS)
    featured = features.add_features(records)

    table = features.model_table(featured)
    parts = training.split(table)
    bench = training.train_and_evaluate(parts, names, presets)
    best, model = bench.best()
    cv = training.cross_validate(table, best, presets=presets)
    artifacts.save_model(spark, model, best, f"{out}/severity_model")
    artifacts.write_table(
        background_sample(parts.test, C.BACKGROUND_TABLE_ROWS), f"{out}/background"
    )

    artifacts.write_table(risk.risk_lookup(featured), f"{out}/risk_lookup", f"{out}/risk_lookup_csv")
    lookup = artifacts.read_table(spark, f"{out}/risk_lookup")
    if lookup.isEmpty():
        raise ValueError("there are no segments to fit the risk model on")
    artifacts.save_model(
        spark, risk_model.fit_risk_model(lookup, risk_trees), "risk", f"{out}/risk_model"
    )

    spots = _spots(spark, records, out)
    document = artifacts.metrics_document(
        spark, dataset, records, bench.results, best, cv, spots
    )
    artifacts.write_metrics(document, f"{out}/metrics")
    return artifacts.read_metrics(spark, f"{out}/metrics")


def main() -> None:
    parser = argparse.ArgumentParser(description="Road-collision analytics")
    parser.add_argument("--raw", required=True, help="raw record CSV files (glob)")
    parser.add_argument("--codes", required=True, help="code list as CSV")
    parser.add_argument("--out", required=True, help="folder for the results")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("kerbstone").getOrCreate()
    document = run(
        spark, raw.read_raw_csv(spark, args.raw), raw.read_code_list(spark, args.codes), args.out
    )
    document.show(truncate=False)


if __name__ == "__main__":
    main()
