"""The trees grown on blocks against those of Spark's own ``GBTRegressor``."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from ringspan import session
from ringspan.operators import gradient as G
from ringspan.operators import trees as M
from ringspan.operators.features import FittedTransform, pass_through

COLS = ["a", "b", "c"]
PASS = FittedTransform([pass_through(c) for c in COLS])


@pytest.fixture(scope="module")
def noisy(spark):
    x = np.random.default_rng(5).normal(size=(1500, 3)).round(2)
    x[:, 2] = np.floor(x[:, 2] * 2)  # few values, many ties
    y = (x[:, 0] * 3 + (x[:, 1] > 0.2) * x[:, 2] + 40).round(3)
    return spark.createDataFrame([(*r, v) for r, v in zip(x.tolist(), y.tolist(), strict=True)], "a double, b double, c double, y double")


def fit(df, **more):
    settings = {"max_iter": 5, "max_depth": 4, "subsample": 1.0, "early_stop": False, "train_fraction": 1.0, "track_history": False}
    return M.fit_boosted_tree_regressor(df, "y", PASS, **{**settings, **more})


def nodes(model):
    return [tuple(r) for r in M.tree_nodes(model).orderBy("tree", "id").drop("model").collect()]


def test_trees_are_those_of_spark(noisy, monkeypatch):
    monkeypatch.setattr(G, "BLOCK_ROWS", 100)
    monkeypatch.setattr(G, "PASS_NUMBERS", 300)  # a node or two a pass
    found = fit(noisy)
    rows = VectorAssembler(inputCols=COLS, outputCol="_features").transform(noisy)
    gbt = GBTRegressor(featuresCol="_features", labelCol="y", maxIter=5, maxDepth=4, stepSize=0.3, subsamplingRate=1.0, maxBins=32, seed=0)
    wanted = gbt.fit(rows)
    mine = found.models[0].stages[-1]
    assert mine.treeWeights == pytest.approx(wanted.treeWeights) and mine.numFeatures == 3
    assert [t.numNodes for t in mine.trees] == [t.numNodes for t in wanted.trees]
    assert mine.featureImportances.toArray() == pytest.approx(wanted.featureImportances.toArray(), abs=0.01)
    a, b = (m.transform(rows).select("a", "b", "c", m.getPredictionCol()).collect() for m in (mine, wanted))
    assert [r[3] for r in a] == pytest.approx([r[3] for r in b], abs=1e-9)


def test_losses_are_those_of_the_model(noisy):
    found = fit(noisy, train_fraction=0.7, subsample=0.6, track_history=True)
    prepared = noisy.withColumn("_held_out", M._content_uniform([*COLS, "y"], 0) >= 0.7)
    rows = VectorAssembler(inputCols=COLS, outputCol="_features").transform(prepared)
    booster = found.models[0].stages[-1]
    for held, name in ((False, "loss"), (True, "eval_loss")):
        wanted = booster.evaluateEachIteration(rows.filter(F.col("_held_out") == held), "squared")
        assert [h[name] for h in found.history] == pytest.approx(wanted)
    covers = {r["tree"]: r["cover"] for r in M.tree_nodes(found).filter("id = 0").collect()}
    trained = rows.filter("not _held_out").count()
    assert len(set(covers.values())) > 1 and all(0.5 * trained < c < 0.7 * trained for c in covers.values())


def test_early_stop_keeps_the_best(noisy):
    held = noisy.withColumn("y", F.col("y") + F.pmod(F.xxhash64("a", "b", "c", "y"), F.lit(100)) / 5)
    found = fit(held, max_iter=12, max_depth=5, train_fraction=0.5, early_stop=True, track_history=True, learn_rate=0.9)
    losses = [h["eval_loss"] for h in found.history]
    assert len(losses) == len(found.models[0].stages[-1].trees) < 12 and losses[-1] == min(losses)


def test_rows_are_not_held_as_objects(spark, noisy, tmp_path):
    """Nothing is cached, and of the blocks none stays."""
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    seen, write = [], G._binned
    with pytest.MonkeyPatch.context() as m:
        m.setattr(G, "_binned", lambda *a: seen.append(write(*a)) or seen[-1])
        m.setattr(GBTRegressor, "fit", lambda *a: pytest.fail("rows went to GBTRegressor"))
        fit(noisy, max_iter=2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    blocks = seen[0].filter("block is not null").select(F.octet_length("codes").alias("n")).collect()
    assert sum(r["n"] for r in blocks) == 3 * 1500
    assert not [p for p in session._scratch if "boosting-blocks" in p]


def test_parallel_trees_share_their_bins(noisy, monkeypatch):
    """Two models over one binned table, each with row samples of its own."""
    seen, made = [], G._binned
    monkeypatch.setattr(G, "_binned", lambda *a: seen.append(made(*a)) or seen[-1])
    found = fit(noisy, max_iter=2, subsample=0.5, num_parallel_tree=2)
    assert len(seen) == 1 and len(found.models) == 2
    first, second = ([r["cover"] for r in M.tree_nodes(found).filter(f"model = {i}").orderBy("tree", "id").collect()] for i in (0, 1))
    assert first != second
    alone = fit(noisy, max_iter=2, subsample=0.5)
    assert [r["cover"] for r in M.tree_nodes(alone).orderBy("tree", "id").collect()] == first


@pytest.mark.parametrize("rows, message", [([], "train on"), ([(1.0, 2.0, 3.0, 4.0)], "held out")])
def test_too_few_rows(spark, rows, message):
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    with pytest.raises(ValueError, match=message):
        fit(df, early_stop=True)


def test_equal_labels_are_a_leaf_and_infinite_features_an_error(spark):
    df = spark.range(300).selectExpr("cast(id as double) a", "cast(id % 7 as double) b", "0.5D c", "0.1D y")
    assert [n[:5] for n in nodes(fit(df, max_iter=2))] == [(0, 0, -1, -1, -1), (1, 0, -1, -1, -1)]
    with pytest.raises(Exception, match="finite"):
        fit(df.withColumn("a", F.lit(float("inf"))))


def test_thresholds():
    assert G.candidate_thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 5) == [1.5, 2.5]
    assert G.candidate_thresholds(np.array([4.0, 4.0]), 5) == []
    assert G.candidate_thresholds(np.arange(100.0), 3) == [24.5, 49.5, 74.5]
