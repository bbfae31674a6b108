"""Plan helpers: global order, skew-tolerant lookups, components, samples, splits."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbstone.operators import sampling
from kerbstone.plans.components import connected_components
from kerbstone.plans.order import global_index, grouped_index, running_totals
from kerbstone.plans.skew import lookup_join


def test_global_index_and_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = {r["x"]: r["i"] for r in global_index(df, [F.col("x")], "i").collect()}
    assert got == {x: x + 1 for x in range(1000)}
    sums = {r["x"]: r["t"] for r in running_totals(df, [F.col("x")], {"t": "x"}).collect()}
    assert sums == {x: x * (x - 1) // 2 for x in range(1000)}


def test_grouped_index_numbers_each_group(spark):
    df = spark.range(300).select(
        F.when(F.col("id") < 200, "big").when(F.col("id") < 290, "mid").alias("g"),
        (-F.col("id")).alias("x"),
    )
    rows = grouped_index(df, "g", [F.col("x")], "i").collect()
    for g in ("big", "mid", None):
        part = sorted((r["x"], r["i"]) for r in rows if r["g"] == g)
        assert [i for _, i in part] == list(range(1, len(part) + 1))


@pytest.mark.parametrize("broadcast_rows", [100_000, 3])
def test_lookup_join_with_a_heavy_key(spark, broadcast_rows):
    big = spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 20).alias("k"),
    )
    lookup = spark.range(15).select(
        F.col("id").alias("k"), (F.col("id") * 10).alias("v"),
        F.when(F.col("id") != 7, F.col("id")).alias("w"),
    )
    got = lookup_join(big, lookup, "k", broadcast_rows, heavy_share=10)
    assert got.columns == ["id", "k", "v", "w"] or set(got.columns) == {"id", "k", "v", "w"}
    rows = {r["id"]: r for r in got.collect()}
    assert len(rows) == 2000
    for r in rows.values():
        known = r["k"] is not None and r["k"] < 15
        assert r["v"] == (r["k"] * 10 if known else None)
        assert r["w"] == (r["k"] if known and r["k"] != 7 else None)


def _union_find(n, edges):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in range(n)}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 29), st.integers(0, 29)), max_size=40))
def test_components_equal_union_find(spark, edges):
    nodes = spark.range(30).select(F.col("id").alias("key"))
    table = spark.createDataFrame(edges or [(0, 0)], "a bigint, b bigint")
    got = {r["key"]: r["component"] for r in connected_components(nodes, table).collect()}
    assert got == _union_find(30, edges)


def test_components_of_a_long_path(spark):
    nodes = spark.range(200).select(F.col("id").alias("key"))
    edges = spark.range(199).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["component"] for r in connected_components(nodes, edges).collect()} == {0}


def _md5(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 57, 500, 900])
def test_fixed_sample_takes_the_least_hashes(spark, n):
    df = spark.range(500).select(F.col("id").cast("string").alias("accident_id"))
    got = {r[0] for r in sampling.fixed_sample(df, n).collect()}
    assert got == set(sorted((str(i) for i in range(500)), key=_md5)[:n])


def test_split_and_folds_keep_class_shares(spark):
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("accident_id"),
        F.when(F.col("id") < 13, "Fatal").when(F.col("id") < 300, "Serious").otherwise("Minor").alias("severity"),
    )
    rows = sampling.stratified_split(df).collect()
    for name, size in (("Fatal", 13), ("Serious", 287), ("Minor", 700)):
        part = [r for r in rows if r["severity"] == name]
        assert len(part) == size and sum(r["is_test"] for r in part) == int(0.2 * size + 0.5)
    folds = sampling.stratified_folds(df).collect()
    for name in ("Fatal", "Serious", "Minor"):
        counts = [sum(r["fold"] == f for r in folds if r["severity"] == name) for f in range(5)]
        assert max(counts) - min(counts) <= 1
