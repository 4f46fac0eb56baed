"""Trees and explanations, autoencoder, anomaly flags, model choice, streams."""

import itertools
import json
import math

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from ringspan.operators import anomaly as D
from ringspan.operators import autoencoder as N
from ringspan.operators import features as X
from ringspan.operators import trees as M
from ringspan.plans.gate import GateParams, train_gate
from ringspan.sources import writers as W
from ringspan.streaming import compact, latest_rows, score_stream, sync_latest, write_stream

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(1500, 2))
    table = np.column_stack([base[:, 0], base[:, 1], base[:, 0] + 0.5 * base[:, 1], rng.integers(0, 3, 1500)])
    y = 3 * base[:, 0] - 2 * (base[:, 1] > 0) + table[:, 3]
    made = [(i, *map(float, t[:3]), "xyz"[int(t[3])], float(v)) for i, (t, v) in enumerate(zip(table, y))]
    return spark.createDataFrame(made, "id int, a double, b double, c double, kind string, y double").repartition(4).cache()


SPECS = [X.standard_scaler("a"), X.min_max_scaler("b"), X.label_encoder("kind", "code"), X.pass_through("y")]


@pytest.fixture(scope="module")
def trees(data):
    return M.fit_boosted_tree_regressor(data, "y", X.FeatureTransform(SPECS), max_iter=6, max_depth=3, num_parallel_tree=2)


@pytest.fixture(scope="module")
def network(data):
    return N.fit_autoencoder(data, COLS, hidden=(8, 2, 8), activation="tanh", max_iter=6, seed=2)


def test_trees_beat_the_mean(data, trees):
    row = D.evaluate(trees, data).first()
    assert row["r2_score"] > 0.7
    assert trees.features == ["a", "b", "code"]


def test_predict_keeps_inputs_and_needs_no_label(data, trees):
    found = M.predict(trees, data.drop("y").withColumn("a", F.when(F.col("id") == 0, None).otherwise(F.col("a"))))
    assert found.columns == ["id", "a", "b", "c", "kind", "predicted_y"]
    assert [r["id"] for r in found.filter("predicted_y is null").collect()] == [0]


def test_model_reload_gives_equal_predictions(data, trees, tmp_path):
    W.save_model(trees, str(tmp_path / "m"))
    again = W.load_model(str(tmp_path / "m"), M.TreeModel)
    assert rows(M.predict(again, data).select("id", "predicted_y")) == rows(M.predict(trees, data).select("id", "predicted_y"))
    assert again.history == trees.history


def test_training_log_has_one_row_per_tree(trees):
    found = N.training_info(trees).collect()
    assert [r["iteration"] for r in found] == list(range(1, len(trees.models[0].stages[-1].trees) + 1))
    assert found[-1]["loss"] < found[0]["loss"]


def test_importance_counts_every_split(trees):
    splits = sum((t.numNodes - 1) // 2 for m in trees.models for t in m.stages[-1].trees)
    assert sum(r["importance_weight"] for r in M.feature_importance(trees).collect()) == splits


def test_explanations_add_up(data, trees):
    for r in M.explain_predict(trees, data, top_k=3).collect():
        total = r["baseline"] + sum(p["attribution"] for p in r["top_feature_attributions"])
        assert total == pytest.approx(r["predicted_y"], abs=1e-9)


def test_attributions_equal_the_definition(trees):
    """Shapley values over all feature orders of the path-dependent expectation, by brute force."""
    nodes = M.tree_nodes(trees).collect()
    leaves, _ = M._leaf_paths(nodes)
    by_tree = {}
    for r in nodes:
        by_tree.setdefault((r["model"], r["tree"]), {})[r["id"]] = r
    count = len({m for m, _ in by_tree})

    def expected(tree, node, x, known):
        if node["left"] < 0:
            return node["prediction"]
        left, right = tree[node["left"]], tree[node["right"]]
        if node["feature"] in known:
            return expected(tree, left if x[node["feature"]] <= node["threshold"] else right, x, known)
        return sum(c["cover"] / node["cover"] * expected(tree, c, x, known) for c in (left, right))

    def value(x, known):
        return sum(t[0]["weight"] / count * expected(t, t[0], x, known) for t in by_tree.values())

    points = np.array([[0.3, 0.4, 1.0], [-1.0, 0.9, 3.0], [2.0, 0.1, 2.0]])
    found = M._attributions(points, leaves)
    for x, row in zip(points, found):
        for i in range(3):
            gains = []
            for order in itertools.permutations(range(3)):
                before = set(order[: order.index(i)])
                gains.append(value(x, before | {i}) - value(x, before))
            assert row[i] == pytest.approx(sum(gains) / math.factorial(3), abs=1e-9)


def test_global_explain_is_the_mean(data, trees):
    per_row = M.explain_predict(trees, data, top_k=3).select(F.explode("top_feature_attributions").alias("p"))
    expected = {r["f"]: r["v"] for r in per_row.groupBy(F.col("p.feature").alias("f")).agg(F.avg(F.abs("p.attribution")).alias("v")).collect()}
    for r in M.global_explain(trees, data).collect():
        assert r["attribution"] == pytest.approx(expected[r["feature"]])


def test_multiclass(data):
    labelled = data.withColumn("label", F.when(F.col("a") > 0.5, 2).when(F.col("a") > -0.5, 1).otherwise(0))
    model = M.fit_multiclass_boosted_tree(labelled, "label", ["a", "b"], max_iter=3)
    wrong = M.predict(model, labelled).filter("label <> predicted_label").count()
    assert wrong < 0.2 * 1500


def test_batch_predict_files(spark, data, trees, tmp_path):
    W.write_jsonl(data, str(tmp_path / "in"))
    M.batch_predict(trees, str(tmp_path / "in"), str(tmp_path / "out"), data.schema, exclude=["c", "y"])
    out = spark.read.json(str(tmp_path / "out"))
    assert out.count() == 1500 and "predicted_y" in out.columns and "c" not in out.columns


def test_network_gradient_is_right():
    net = N.Network((3, 4, 2, 3), "tanh", "linear")
    flat, x = net.start(1), np.random.default_rng(0).normal(size=(5, 3))
    _, grad = net.gradient(flat, x)
    for i in range(0, len(flat), 5):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        high = ((net.outputs(flat + step, x)[-1] - x) ** 2).mean()
        low = ((net.outputs(flat - step, x)[-1] - x) ** 2).mean()
        assert grad[i] == pytest.approx((high - low) / 2e-6, abs=1e-6)


def test_autoencoder_learns_and_reloads(data, network, tmp_path):
    losses = [r["eval_loss"] for r in N.training_info(network).collect()]
    assert losses[-1] < losses[0] and min(losses) < 0.7
    W.save_model(network, str(tmp_path / "ae"))
    again = W.load_model(str(tmp_path / "ae"), N.AutoencoderModel)
    assert rows(D.reconstruction_loss(again, data).select("id", "mean_squared_error")) == rows(
        D.reconstruction_loss(network, data).select("id", "mean_squared_error")
    )


def test_autoencoder_is_repeatable(data, network):
    again = N.fit_autoencoder(data, COLS, hidden=(8, 2, 8), activation="tanh", max_iter=6, seed=2)
    assert np.allclose(again.weights, network.weights, atol=1e-6)


def test_linear_reconstructor_is_exact_at_full_rank(data):
    model = N.fit_pca_reconstructor(data, COLS, 2)  # the third column is a combination of the others
    assert D.evaluate(model, data).first()["mean_squared_error"] < 1e-9


def test_missing_input_has_no_error(spark, network):
    df = spark.createDataFrame([(1, 1.0, None, 2.0), (2, 1.0, 1.0, 1.0)], "id int, a double, b double, c double")
    found = {r["id"]: r for r in D.detect_anomalies(network, df, 0.5).collect()}
    assert found[1]["mean_squared_error"] is None and found[1]["is_anomaly"] is False
    network.thresholds.clear()


def test_contamination_flags_that_share(data, network):
    D.fit_threshold(network, data, 0.04)
    assert D.detect_anomalies(network, data, 0.04).filter("is_anomaly").count() == 60


def test_search_and_trials(data):
    grid = {"activation": ["relu", "sigmoid"], "optimizer": ["adam", "sgd"], "hidden": [(4, 2, 4)]}
    search = N.hyperparameter_search(data, COLS, grid, num_trials=3, max_iter=2)
    found = N.trial_info(search).collect()
    assert len(found) == 3 and sum(r["is_best"] for r in found) == 1
    assert next(r for r in found if r["is_best"])["loss"] == min(r["loss"] for r in found)
    assert D.reconstruction_loss(search, data, trial_id=2).count() == 1500


@pytest.mark.parametrize("higher, best, deploy", [(False, "challenger", True), (True, "blessed", False)])
def test_compare_models(spark, higher, best, deploy):
    metrics = spark.createDataFrame([("challenger", "m", 0.2), ("blessed", "m", 0.3), ("x", "other", 0.0)], "model string, metric string, value double")
    row = D.compare_models(metrics, "m", 15.0, higher).first()
    assert (row["best_model"], row["deploy"]) == (best, deploy)


def test_probe_rows(spark, network):
    good = spark.createDataFrame([(0.6, 1.0, 4.5)], "a double, b double, c double")
    assert math.isfinite(D.validate_scored_rows(network, good).first()["mean_squared_error"])
    with pytest.raises(ValueError, match="1 probe rows"):
        D.validate_scored_rows(network, good.withColumn("a", F.lit(None).cast("double")))


def test_gate_stores_the_winner(data, network, tmp_path):
    halves = data.filter("a > 0"), data.filter("a <= 0")
    params = GateParams(COLS, challenger={"max_iter": 3}, model_path=str(tmp_path / "won"))
    decision, _ = train_gate(*halves, params)
    assert decision.first()["best_model"] == "challenger" and decision.first()["deploy"]
    assert N.AutoencoderModel.load(str(tmp_path / "won")).thresholds
    strict = GateParams(COLS, threshold=1e-9, challenger={"max_iter": 1})
    assert not train_gate(*halves, strict, network)[0].first()["deploy"]


def test_agreement_counts_fan_out(spark):
    p = spark.createDataFrame([("k", True), ("k", False), ("q", True)], "key string, is_anomaly boolean")
    a = spark.createDataFrame([("k", True), ("k", True), ("z", False)], "key string, is_anomaly boolean")
    assert rows(D.anomaly_agreement(p, a, ["key"])) == [(False, True, 2), (True, True, 2)]
    assert rows(D.agreeing_rows(p, a, ["key"])) == [("k", True, True, 2)]


def test_stream_equals_batch(spark, data, trees, network, tmp_path):
    data.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    write_stream(score_stream(stream, trees), str(tmp_path / "out"), str(tmp_path / "state"))
    found = rows(spark.read.parquet(str(tmp_path / "out")).select("id", "predicted_y"))
    assert found == rows(M.predict(trees, data).select("id", "predicted_y"))
    D.fit_threshold(network, data, 0.04)
    write_stream(score_stream(stream, network, 0.04), str(tmp_path / "out2"), str(tmp_path / "state2"))
    assert spark.read.parquet(str(tmp_path / "out2")).filter("is_anomaly").count() == 60


def test_sync_latest_over_batches(spark, tmp_path):
    source, table, state = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "state")
    schema = "key string, t int, v string"

    def sync():
        stream = spark.readStream.schema(schema).parquet(source)
        sync_latest(stream, "key", "t", table, state).awaitTermination()

    spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], schema).write.parquet(source)
    sync()
    spark.createDataFrame([("a", 1, "late"), ("b", 5, "new"), ("c", 1, "c")], schema).write.mode("append").parquet(source)
    sync()
    assert rows(latest_rows(spark, table, "key", "t")) == [("a", 2, "y"), ("b", 5, "new"), ("c", 1, "c")]


def test_without_early_stop_all_trees_are_fitted(data):
    model = M.fit_boosted_tree_regressor(data, "y", X.FeatureTransform(SPECS), max_iter=4, max_depth=2, early_stop=False)
    assert len(model.models[0].stages[-1].trees) == 4 and len(model.history) == 4


def test_rows_with_a_missing_feature_are_explained_as_null(data, trees):
    first = "a"
    broken = data.withColumn(first, F.when(F.col("id") % 5 > 0, F.col(first)))
    found = M.explain_predict(trees, broken)
    assert found.count() == data.count()
    empty = found.filter("predicted_y is null")
    assert empty.count() > 0 and empty.filter("top_feature_attributions is not null").count() == 0


def test_thresholds_of_scored_rows_are_not_kept(spark):
    train = spark.range(400).select(*[(F.rand(i) * 10).alias(c) for i, c in enumerate("abc")])
    model = N.fit_pca_reconstructor(train, ["a", "b", "c"], 1)
    wild, calm = train.select(*[(F.col(c) * 1000).alias(c) for c in "abc"]), train
    assert D.detect_anomalies(model, wild, 0.04).filter("is_anomaly").count() == 16 and not model.thresholds
    assert D.detect_anomalies(model, calm, 0.04).filter("is_anomaly").count() == 16


def test_columns_without_values_are_named(spark):
    empty = spark.range(50).select(F.col("id").cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    with pytest.raises(ValueError, match="b"):
        N.fit_autoencoder(empty, ["a", "b"])


def test_trials_share_their_passes(spark, monkeypatch):
    """Eight trials take no more passes than one; the halving leaves one with all iterations."""
    passes, bound = [], N._bound
    monkeypatch.setattr(N, "_bound", lambda train, trials: passes.append(len(trials)) or bound(train, trials))
    train = spark.range(300).select(*[(F.rand(i) * 10).alias(c) for i, c in enumerate("ab")])
    grid = {"activation": ["relu", "sigmoid"], "optimizer": ["adam", "sgd"], "lr": [0.01, 0.1]}
    search = N.hyperparameter_search(train, ["a", "b"], grid, num_trials=8, max_iter=8, early_stop=False)
    assert passes == [8, 8, 4, 4, 2, 2, 2, 2, 1, 1, 1, 1, 1, 1, 1, 1]
    info = N.trial_info(search)
    assert sorted(r["iterations"] for r in info.collect()) == [1, 1, 1, 1, 2, 2, 4, 8]
    passes.clear()
    whole = N.hyperparameter_search(train, ["a", "b"], grid, num_trials=8, max_iter=3, early_stop=False, halving=None)
    assert passes == [8] * 6 and all(t["iterations"] == 3 for t in whole.trials)
    alone = N.fit_autoencoder(train, ["a", "b"], activation="sigmoid", optimizer="sgd", lr=0.1, max_iter=3, early_stop=False)
    same = next(t for t in whole.trials if json.loads(t["hyperparameters"]) == {"activation": "sigmoid", "optimizer": "sgd", "lr": 0.1})
    assert abs(min(h["eval_loss"] for h in alone.history) - same["loss"]) < 1e-3 * same["loss"] + 0.05


def test_search_reload(spark, tmp_path):
    train = spark.range(300).select(*[(F.rand(i) * 10).alias(c) for i, c in enumerate("ab")])
    search = N.hyperparameter_search(train, ["a", "b"], {"activation": ["relu", "sigmoid"]}, max_iter=1)
    search.save(str(tmp_path / "s"))
    again = N.Search.load(str(tmp_path / "s"))
    assert again.trials == search.trials and N.np.allclose(again.model().weights, search.model().weights)


def test_serving_table_survives_a_lost_checkpoint(spark, tmp_path):
    schema = "k int, t int, v string"
    for n, batch in enumerate(([(1, 1, "a"), (2, 1, "b")], [(1, 2, "c")])):
        spark.createDataFrame(batch, schema).write.parquet(str(tmp_path / f"in{n}"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / f"in{n}"))
        sync_latest(stream, "k", "t", str(tmp_path / "serving"), str(tmp_path / f"state{n}")).awaitTermination()
    assert rows(latest_rows(spark, str(tmp_path / "serving"), "k", "t")) == [(1, 2, "c"), (2, 1, "b")]
    folded = compact(spark, str(tmp_path / "serving"), "k", "t", str(tmp_path / "new"))
    assert rows(folded) == [(1, 2, "c"), (2, 1, "b")]
