"""Histogram boosting: hand-worked trees, leaf-wise growth, penalties, fractions, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringspan.operators import aggregates as A
from ringspan.operators import boosting as B
from ringspan.operators import features as X
from ringspan.operators import trees as M
from ringspan.operators.ordered import train_test_split
from ringspan.sources import writers as W

PASS = X.FittedTransform([X.pass_through("x")])


def regress(df, **more):
    settings = {"max_iter": 1, "max_depth": 1, "learn_rate": 1.0, "subsample": 1.0, "early_stop": False, "train_fraction": 1.0, "l2_reg": 2.0}
    return M.fit_boosted_tree_regressor(df, "y", PASS, **{**settings, **more})


def test_a_tree_worked_by_hand(spark):
    """y = 0, 2, 10 at x = 1, 2, 3: mean 4; residuals -4, -2, 6. With l1 = 1 and l2 = 2 the cut behind 2 takes most off
    the loss: ((6-1)^2 / (2+2) + (6-1)^2 / (1+2) - 0) / 2. Leaves: -(6-1)/4 and (6-1)/3."""
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 2.0), (3.0, 10.0)], "x double, y double")
    model = regress(df, l1_reg=1.0)
    nodes = {r["id"]: r for r in M.tree_nodes(model).filter("tree = 1").collect()}
    assert nodes[0]["threshold"] == 2.0 and nodes[0]["gain"] == pytest.approx((25 / 4 + 25 / 3) / 2)
    assert [nodes[i]["prediction"] for i in (1, 2)] == pytest.approx([-1.25, 5 / 3]) and nodes[1]["cover"] == 2.0
    found = [r["predicted_y"] for r in M.predict(model, df).orderBy("x").collect()]
    assert found == pytest.approx([2.75, 2.75, 4 + 5 / 3])
    # A penalty above every sum of residuals leaves the mean.
    flat = regress(df, l1_reg=100.0)
    assert [r["predicted_y"] for r in M.predict(flat, df).collect()] == [4.0] * 3


def test_softmax_scores_worked_by_hand(spark):
    """Shares 1/2, 1/4, 1/4; the cut at x <= 0 parts class 0 from the others."""
    df = spark.createDataFrame([(0.0, 0), (0.0, 0), (1.0, 1), (1.0, 2)], "x double, y int")
    model = M.fit_multiclass_boosted_tree(df, "y", ["x"], max_iter=1, max_depth=1, learn_rate=1.0, feature_fraction=1.0, subsample=1.0, l2_reg=1.0, min_rows=1)
    scores = model.scores(model.bins(np.array([[0.0], [1.0]])))
    # class 0: residuals 1/2 at x=0, -1/2 at x=1, two rows each, second derivatives 1/4; others by 3/16.
    want0 = [np.log(0.5) + 1 / (0.5 + 1), np.log(0.5) - 1 / (0.5 + 1)]
    want1 = [np.log(0.25) - 0.5 / (0.375 + 1), np.log(0.25) + 0.5 / (0.375 + 1)]
    assert scores[:, 0] == pytest.approx(want0) and scores[:, 1] == pytest.approx(want1) and scores[:, 2] == pytest.approx(want1)


def strict(x, y, leaves, l2=2.0):
    """Leaf-wise growth by trying every cut of every leaf, the best one first; returns the sorted leaf sizes."""
    groups = [np.arange(len(x))]
    g = y.mean() - y
    worth = lambda rows: g[rows].sum() ** 2 / (len(rows) + l2) if len(rows) else 0.0
    while len(groups) < leaves:
        best = None
        for i, rows in enumerate(groups):
            for cut in np.unique(x[rows])[:-1]:
                left, right = rows[x[rows] <= cut], rows[x[rows] > cut]
                gain = worth(left) + worth(right) - worth(rows)
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, i, left, right)
        if best is None or best[0] <= 1e-9:
            break
        groups[best[1]] = best[2]
        groups.append(best[3])
    return sorted(sorted(rows.tolist()) for rows in groups)


def test_growth_is_leaf_wise(spark):
    rng = np.random.default_rng(6)
    x = np.arange(40.0)
    y = np.where(x < 30, 0.0, (x - 30) ** 2) + rng.normal(scale=0.3, size=40)  # all the gain is on one side
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x double, y double").repartition(3)
    rows = df.withColumn("_held_out", F.lit(False))
    for leaves in (2, 4, 6):
        model = B.fit_boosted(rows, "y", ["x"], PASS, "regressor", max_iter=1, max_depth=8, num_leaves=leaves, learn_rate=1.0, l2_reg=2.0, max_bins=256)
        at = model.rounds[0][0].leaves(model.bins(x[:, None]))
        assert sorted(np.flatnonzero(at == leaf).tolist() for leaf in np.unique(at)) == strict(x, y, leaves)


def test_rings_as_well_as_one_against_the_rest(spark):
    """Three rings, where one class lies between two others."""
    rng = np.random.default_rng(11)
    angle, ring = rng.uniform(0, 2 * np.pi, 2000), rng.integers(0, 3, 2000)
    radius = 1.0 + ring + rng.normal(scale=0.35, size=2000)
    data = [(i, float(r * np.cos(a)), float(r * np.sin(a)), float(rng.normal()), int(k)) for i, (r, a, k) in enumerate(zip(radius, angle, ring, strict=True))]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, ring int").repartition(4)
    train, test = train_test_split(df, 0.7, "id", 1)
    settings = {"max_iter": 6, "max_depth": 3, "learn_rate": 0.5, "feature_fraction": 1.0}
    errors = [
        A.multiclass_error(M.predict(fit(train, "ring", ["a", "b", "c"], **settings), test), "ring", "predicted_ring").first()[0]
        for fit in (M.fit_multiclass_boosted_tree, M.fit_one_vs_rest_trees)
    ]
    assert errors[0] <= errors[1] + 0.03 and errors[0] < 0.25


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 3))
    y = 2 * x[:, 0] + (x[:, 1] > 0) + rng.normal(scale=0.2, size=1200)
    return spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double, c double, y double").repartition(4)


THREE = X.FittedTransform([X.pass_through(c) for c in "abc"])


def test_reload_explanations_and_history(spark, noisy, tmp_path):
    model = M.fit_boosted_tree_regressor(noisy, "y", THREE, max_iter=8, max_depth=3, l2_reg=1.0, early_stop=False)
    assert len(model.history) == 8 and model.history[-1]["eval_loss"] < 0.4 * model.history[0]["eval_loss"]
    W.save_model(model, str(tmp_path / "m"))
    again = W.load_model(str(tmp_path / "m"), B.BoostedModel)
    first, second = (M.predict(m, noisy).orderBy("a").collect() for m in (model, again))
    assert first == second
    explained = M.explain_predict(model, noisy.limit(50), top_k=3).collect()
    for r in explained:
        assert r["baseline"] + sum(p["attribution"] for p in r["top_feature_attributions"]) == pytest.approx(r["predicted_y"], abs=1e-9)
    assert [r["feature"] for r in M.global_explain(model, noisy).collect()][0] == "a"
    assert M.feature_importance(model).first()["feature"] == "a"


def test_same_model_for_any_partitioning(spark, noisy):
    fit = lambda df: M.fit_boosted_tree_regressor(df, "y", THREE, max_iter=3, l1_reg=0.5, subsample=0.6, early_stop=False, seed=4)
    one, two = fit(noisy), fit(noisy.repartition(2, "c"))
    assert [(t.feature, t.bin, t.left) for (t,) in one.rounds] == [(t.feature, t.bin, t.left) for (t,) in two.rounds]
    trained = noisy.count() * 0.8
    assert 0.5 * trained < one.rounds[0][0].cover[0] < 0.7 * trained


def test_odd_rows(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 1), (2.0, None), (5.0, 2), (1.0, 0)], "x double, y int")
    model = M.fit_multiclass_boosted_tree(df, "y", ["x"], max_iter=2, subsample=1.0)
    found = M.predict(model, df.drop("y").withColumn("predicted", F.lit(1)))
    assert found.columns == ["x", "predicted", "predicted_y"]
    assert [r["predicted_y"] for r in found.collect()][1] is None and len(model.base) == 3  # class 1 has no complete row
    with pytest.raises(ValueError, match="classes"):
        M.fit_multiclass_boosted_tree(df.filter("x is null"), "y", ["x"])
    with pytest.raises(ValueError, match="num_parallel_tree"):
        regress(spark.createDataFrame([(1.0, 1.0)], "x double, y double"), num_parallel_tree=2)
    same = regress(spark.createDataFrame([(1.0, 3.0), (1.0, 5.0)], "x double, y double"))
    assert [r["predicted_y"] for r in M.predict(same, df.select("x")).collect()] == [4.0, None, 4.0, 4.0, 4.0]
