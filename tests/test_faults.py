"""Rows that were once lost or mixed up."""

import datetime

import pytest
from pyspark.sql import functions as F

from kerbstone import constants as C
from kerbstone.functions.scalars import trimmed
from kerbstone.operators import hotspots
from kerbstone.operators.explain import attribution
from kerbstone.operators.ml import smote
from kerbstone.operators.spatial import dbscan, kmeans
from kerbstone.sources import raw


def test_files_with_columns_in_another_order(spark, tmp_path):
    for name, columns in (("a", raw.RAW_COLUMNS), ("b", raw.RAW_COLUMNS[::-1])):
        values = [f"{name}-{c}" for c in columns]
        (tmp_path / f"{name}.csv").write_text(f"{','.join(columns)}\n{','.join(values)}\n")
    rows = raw.read_raw_csv(spark, str(tmp_path / "*.csv")).collect()
    assert len(rows) == 2
    for r in rows:
        name = r["collision_index"][0]
        assert r.asDict() == {c: f"{name}-{c}" for c in raw.RAW_COLUMNS}


def test_prepared_files_with_columns_in_another_order(spark, tmp_path):
    columns = [f.name for f in raw.PREPARED_SCHEMA.fields]
    value = {c: "7" for c in columns} | {"date": "2023-01-02", "city": "York"}
    for name, order in (("a", columns), ("b", columns[::-1])):
        (tmp_path / f"{name}.csv").write_text(",".join(order) + "\n" + ",".join(value[c] for c in order) + "\n")
    rows = raw.read_prepared_csv(spark, str(tmp_path)).collect()
    assert [(r["city"], r["date"], r["hour"]) for r in rows] == [("York", datetime.date(2023, 1, 2), 7.0)] * 2


def test_a_file_without_a_column_is_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("collision_index\n1\n")
    with pytest.raises(ValueError, match="a.csv has no column"):
        raw.read_raw_csv(spark, str(tmp_path))


def test_records_without_id_stay_in_zones_clusters_and_hotspots(spark):
    rows = [(None if i == 0 else str(i), 53.0 + i * 1e-4, -1.0, "Fatal", "York") for i in range(12)]
    df = spark.createDataFrame(rows, "accident_id string, latitude double, longitude double, severity string, city string")
    kept = ("latitude", "longitude", "severity", "city")
    placed = dbscan.dbscan(df, 1.5, 5, keep=kept)
    assert placed.columns == ["accident_id", *kept, "cluster"] and placed.count() == 12
    assert hotspots.rank_hotspots(placed).first()["n_accidents"] == 12
    zoned = kmeans.kmeans_labels(kmeans.fit_kmeans(df, k=2, starts=1), df, keep=kept)
    assert sorted(r["latitude"] for r in zoned.collect()) == sorted(r[1] for r in rows)


def test_a_rare_record_without_id_is_balanced(spark):
    rows = []
    for i in range(40):
        label = 0 if i < 30 else 1
        values = {c: "x" for c in C.FEATURES} | {c: float(i) for c in C.NUMERIC_FEATURES}
        rows.append((None if i in (0, 35) else str(i), label, i + 1 if label == 0 else i - 29, *values.values()))
    types = ["double" if c in C.NUMERIC_FEATURES else "string" for c in values]
    schema = "accident_id string, label int, train_rank long, " + ", ".join(
        f"{c} {t}" for c, t in zip(values, types))
    train = spark.createDataFrame(rows, schema)
    distinct = smote.profiles(train)
    assert distinct.where("profile is null").count() == 0
    near = smote.with_neighbours(distinct, smote.scales(train))
    assert smote.synthetic_rows(near).where("other is not null").count() == 20


def test_white_space_of_any_kind_is_trimmed(spark):
    df = spark.createDataFrame([(" \t  E0 1\r\n ",), (None,), ("",)], "a string")
    assert [r[0] for r in df.select(trimmed("a")).collect()] == ["E0 1", None, ""]


def test_shapley_values_of_a_product_are_exact(spark, monkeypatch):
    a, b = C.NUMERIC_FEATURES[:2]

    def product(model, df):
        return df.withColumn("probabilities", F.array(F.col(a).cast("double") * F.col(b).cast("double")))

    monkeypatch.setattr(attribution, "score", product)
    numbers = [(i, [float((i * 7 + j * 3) % 11) for j in range(len(attribution.PLAYERS))]) for i in range(9)]
    ddl = ", ".join(f"{c} {'double' if c in C.NUMERIC_FEATURES else 'string'}" for c in attribution.PLAYERS)
    rows = [
        (str(i), *[v if c in C.NUMERIC_FEATURES else str(v) for c, v in zip(attribution.PLAYERS, vs)]) for i, vs in numbers
    ]
    df = spark.createDataFrame(rows, f"accident_id string, {ddl}")
    background = df.where("accident_id < '4'")
    at = {c: attribution.PLAYERS.index(c) + 1 for c in (a, b)}
    got = {(r["accident_id"], r["feature"]): r["phi"]
           for r in attribution.shapley_values(None, df, background, class_index=0).collect()}
    for row in rows:
        for one, other in ((a, b), (b, a)):
            want = sum((row[at[one]] - z[at[one]]) * (row[at[other]] + z[at[other]]) / 2 for z in rows[:4]) / 4
            assert abs(got[row[0], one] - want) < 1e-9
