"""Fits leave nothing behind in the scratch folder, and what is written between rounds changes nothing."""

import os

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from kerbstone.operators.ml import boosting, forest
from kerbstone.plans.cut import cut, discard, scratch_root, settled


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 5, (300, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] + rng.integers(0, 2, 300)).astype(int) % 3
    frame = spark.createDataFrame([(int(a), [float(v) for v in r]) for a, r in zip(y, x)], "label int, x array<double>")
    return frame.select("label", array_to_vector("x").alias("features"))


def held(spark):
    root = scratch_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_states_of_a_fit_are_removed(spark, train, monkeypatch):
    preset = boosting.BoostingPreset(rounds=7, depth=2)
    before, written, trees = held(spark), [], []
    for rounds in (100, 2):
        monkeypatch.setattr(boosting, "ROUNDS_PER_CUT", rounds)
        monkeypatch.setattr(boosting, "cut", lambda df: written.append(held(spark) - before) or cut(df))
        trees.append(boosting.fit_boosting(train, preset).stages[0].getOrDefault("trees"))
    # the first fit writes its state once, the second once more after two rounds each
    assert [len(w) for w in written] == [0, 0, 1, 1, 1]
    assert trees[0] == trees[1]
    forest.fit_forest(train, 2, 2)
    assert held(spark) == before


def test_only_a_cut_can_be_discarded(spark, train, tmp_path):
    path = str(tmp_path / "t")
    train.select("label").write.parquet(path)
    with pytest.raises(ValueError):
        discard(spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 300


def test_what_a_result_took_is_removed_and_the_result_stays(spark, train):
    before = held(spark)
    inner = []

    def make():
        inner.append(cut(train.select("label")))
        return settled(spark, lambda: cut(inner[0].where("label > 0"))).groupBy("label").count()

    out = settled(spark, make)
    assert len(held(spark) - before) == 1  # neither the two cuts nor the settled one in between
    assert sum(r["count"] for r in out.collect()) == train.where("label > 0").count()
    kept = cut(out)  # outside, a cut stays
    discard(out)
    assert kept.count() == 2 and len(held(spark) - before) == 1
    with pytest.raises(ZeroDivisionError):
        settled(spark, lambda: 1 / 0)
    discard(kept)
    assert held(spark) == before


def test_a_fit_leaves_no_balanced_rows(spark, small):
    import kerbstone.queries as Q
    from kerbstone.operators.ml import classifiers, training

    parts = training.split(Q._model_table(spark, small))
    before = held(spark)
    training.fitted("logistic_regression", parts.train, classifiers.Presets(iterations=5))
    assert held(spark) == before
