"""What is read or sent once stays so: ranks in the row, zones written before several passes."""

from pyspark.sql import functions as F

import kerbstone.queries as Q
from kerbstone import constants as C
from kerbstone.operators import risk
from kerbstone.operators.explain import attribution
from kerbstone.operators.spatial import kmeans, silhouette

PLACES = [(f"p{i}", 50.0 + i % 7, -3.0 + i % 5, "a" if i % 2 else "b") for i in range(60)]


def counted(spark, rows, column):
    """``rows`` with ``column`` passed through a counter, and the counter."""
    seen = spark.sparkContext.accumulator(0)

    def same(value):
        seen.add(1)
        return value

    return rows.withColumn(column, F.udf(same, "string")(column)), seen


def test_strongest_columns_are_ranked_in_the_row(spark):
    blank = {c: "x" for c in C.CATEGORICAL_FEATURES} | {c: 1.0 for c in C.NUMERIC_FEATURES}
    rows = [{**blank, "accident_id": f"a{i}", "weather": "Other" if i % 3 else "Unknown", "hour": float(i % 5),
             "is_night": None if i == 4 else float(i % 2), "speed_limit": 10.0 * (i % 4)} for i in range(20)]
    schema = ", ".join(["accident_id string", *[f"{c} string" for c in C.CATEGORICAL_FEATURES],
                        *[f"{c} double" for c in C.NUMERIC_FEATURES]])
    alone = spark.createDataFrame([[r[c] for c in ["accident_id", *C.FEATURES]] for r in rows], schema)
    several = alone.union(alone.limit(3)).union(alone.limit(2).withColumn("accident_id", F.lit(None).cast("string")))
    terms = attribution.linear_terms({"weather": C.WEATHER_WEIGHTS}, {c: 0.1 for c in C.NUMERIC_FEATURES})

    def plain(df):
        return sorted(map(repr, df.select("accident_id", "feature", "phi", "rank").collect()))

    for table in (alone, several):
        got = attribution.strongest_linear(table, table, terms, top=5)
        assert plain(got) == plain(attribution.strongest(attribution.linear_attributions(table, table, terms), 5))
    plan = attribution.strongest_linear(alone, alone, terms)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_whole_silhouette_finds_zones_once(spark):
    rows, seen = counted(spark, spark.createDataFrame(PLACES, "id string, x double, y double, zone string"), "zone")
    assert silhouette.whole_silhouette(rows, "x", "y", "zone").first()[0] is not None
    assert seen.value == len(PLACES)


def test_few_centroids_are_compared_without_a_lambda(spark):
    rows = spark.createDataFrame(PLACES + [("none", None, 1.0, "a")], "id string, latitude double, longitude double, zone string")
    centres = [(str(i), 50.0 + i, -3.0 + i % 3) for i in range(6)]
    near = kmeans.nearest_centroid(rows, spark.createDataFrame(centres, "cluster string, centre_lat double, centre_lon double"))
    assert "lambda" not in near._jdf.queryExecution().analyzed().toString()
    for r in near.where("latitude is not null").collect():
        assert r["cluster"] == min(centres, key=lambda c: ((r["latitude"] - c[1]) ** 2 + (r["longitude"] - c[2]) ** 2, c[0]))[0]


def test_risk_lookup_reads_records_once(spark, small):
    rows, seen = counted(spark, Q.featured(spark, small), "weather")
    n = Q.featured(spark, small).count()
    assert risk.risk_lookup(rows).collect() and seen.value == n
