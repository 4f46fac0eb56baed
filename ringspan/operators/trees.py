"""Boosted trees: fitting, scoring, importance and explanations."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.readers import scan_jsonl
from ..sources.writers import write_jsonl
from .boosting import BoostedModel, fit_boosted, nodes_of, score
from .columns import select_features
from .features import FeatureTransform, FittedTransform, pass_through
from .gradient import fit_gradient_boosted


#: Numbers that are worth a partition of their own; Spark's trees cache some 34 bytes for each.
PARTITION_VALUES = 4_000_000


@dataclass
class TreeModel:
    """A fitted transform with one or more boosted models over its outputs; predictions are their mean."""

    label: str
    features: list[str]
    transform: FittedTransform
    models: list[PipelineModel]
    kind: str = "regressor"
    history: list[dict] = field(default_factory=list)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {"label": self.label, "features": self.features, "kind": self.kind, "history": self.history,
                "models": len(self.models)}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
        self.transform.save(spark, f"{path}/transform")
        for i, model in enumerate(self.models):
            model.write().overwrite().save(f"{path}/model-{i}")

    @classmethod
    def load(cls, path: str) -> TreeModel:
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        models = [PipelineModel.load(f"{path}/model-{i}") for i in range(meta["models"])]
        transform = FittedTransform.load(spark, f"{path}/transform")
        return cls(meta["label"], meta["features"], transform, models, meta["kind"], meta["history"])


def _content_uniform(cols: Sequence[str], seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1_000_000)) / 1_000_000


def _prepared(df: DataFrame, label: str, transform) -> tuple[FittedTransform, list[str], DataFrame]:
    fitted = transform.fit(df) if isinstance(transform, FeatureTransform) else transform
    features = [c for c in fitted.outputs if c != label]
    keep = [] if label in fitted.outputs else [label]
    rows = fitted.transform(df, keep=keep).dropna("any", subset=[label, *features])
    return fitted, features, rows.withColumn(label, F.col(label).cast("double"))


def _dealt(rows: DataFrame, values: int, count: int | None = None) -> DataFrame:
    """Rows (blocks of ``count`` rows) of ``values`` numbers each in as many partitions as they are worth, if the scan gave fewer.

    A split of a dense file holds many rows, and every pass over the trees' rows reads each partition in one task.
    """
    wanted = -(-(rows.count() if count is None else count) * values // PARTITION_VALUES)
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted else rows


def fit_boosted_tree_regressor(
    df: DataFrame, label: str, transform: FeatureTransform | FittedTransform, max_iter: int = 20, max_depth: int = 5,
    learn_rate: float = 0.3, subsample: float = 0.85, early_stop: bool = True, min_rel_progress: float = 0.01,
    train_fraction: float = 0.8, num_parallel_tree: int = 1, l1_reg: float = 0.0, l2_reg: float = 0.0,
    max_bins: int = 32, seed: int = 0, track_history: bool = True,
) -> TreeModel:
    """Boosted regression trees over a feature transform, with a held-out part chosen by row content.

    Without ``early_stop`` all ``max_iter`` trees are fitted, still on the rows not held out. ``track_history`` measures
    the loss of every iteration on both parts, in the passes that grow the trees.
    ``num_parallel_tree`` fits that many models with different row samples and averages them. Trees of
    Spark ML know no l1 or l2 penalty: with one of them the trees of ``boosting`` are fitted, one model of them.
    """
    if (l1_reg or l2_reg) and num_parallel_tree > 1:
        raise ValueError("penalties go with num_parallel_tree=1")
    fitted, features, rows = _prepared(df, label, transform)
    rows = rows.withColumn("_held_out", _content_uniform([*features, label], seed) >= train_fraction)
    if l1_reg or l2_reg:
        return fit_boosted(
            rows, label, features, fitted, "regressor", max_iter, max_depth, 1 << max_depth, learn_rate, 1.0, subsample, l1_reg, l2_reg,
            max_bins=max_bins, early_stop=early_stop, min_rel_progress=min_rel_progress, track_history=track_history, seed=seed,
        )
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    rows = rows.select(*[f"`{c}`" for c in features], f"`{label}`", "_held_out")
    stop = {"validationIndicatorCol": "_held_out", "validationTol": min_rel_progress} if early_stop else {}
    boosters = [
        GBTRegressor(
            featuresCol="_features", labelCol=label, predictionCol="_prediction", maxIter=max_iter,
            maxDepth=max_depth, stepSize=learn_rate, subsamplingRate=subsample, maxBins=max_bins, seed=seed + i, **stop,
        )
        for i in range(num_parallel_tree)
    ]
    found = fit_gradient_boosted(boosters, rows, lambda blocks, n: _dealt(blocks, len(features), n), early_stop, track_history)
    models = [PipelineModel([assembler, model]) for model, _ in found]
    history = found[0][1]
    return TreeModel(label, features, fitted, models, "regressor", history)


def fit_multiclass_boosted_tree(
    df: DataFrame, label: str, features: Sequence[str], max_iter: int = 20, max_depth: int = 5, num_leaves: int = 31,
    learn_rate: float = 0.05, feature_fraction: float = 0.9, subsample: float = 0.8, l1_reg: float = 0.0, l2_reg: float = 0.0,
    min_rows: int = 10, held_out: float = 0.0, early_stop: bool = False, min_rel_progress: float = 0.0, seed: int = 0,
) -> BoostedModel:
    """Boosted trees for integer classes from 0: a tree per class and round on the gradients of the softmax loss, grown
    leaf by leaf to ``num_leaves``. ``held_out`` rows, by content, are measured only."""
    fitted, names, rows = _prepared(df, label, FittedTransform([pass_through(c) for c in features]))
    rows = rows.withColumn("_held_out", _content_uniform([*names, label], seed) < held_out)
    return fit_boosted(
        rows, label, names, fitted, "multiclass", max_iter, max_depth, num_leaves, learn_rate, feature_fraction, subsample, l1_reg, l2_reg,
        min_rows, early_stop=early_stop, min_rel_progress=min_rel_progress, track_history=held_out > 0, seed=seed,
    )


def fit_one_vs_rest_trees(
    df: DataFrame, label: str, features: Sequence[str], max_iter: int = 20, max_depth: int = 5,
    learn_rate: float = 0.05, feature_fraction: float = 0.9, subsample: float = 0.8, seed: int = 0, parallelism: int = 8,
) -> TreeModel:
    """Boosted trees for integer classes from 0: one model per class against the rest, ``parallelism`` at a time."""
    fitted, names, rows = _prepared(df, label, FittedTransform([pass_through(c) for c in features]))
    assembler = VectorAssembler(inputCols=names, outputCol="_features")
    gbt = GBTClassifier(
        maxIter=max_iter, maxDepth=max_depth, stepSize=learn_rate, subsamplingRate=subsample,
        featureSubsetStrategy=str(feature_fraction), seed=seed,
    )
    many = OneVsRest(classifier=gbt, featuresCol="_features", labelCol=label, predictionCol="_prediction", parallelism=parallelism)
    rows = _dealt(assembler.transform(rows).select("_features", label), len(names)).persist()
    try:
        model = many.fit(rows)
    finally:
        rows.unpersist()
    return TreeModel(label, names, fitted, [PipelineModel([assembler, model])], "multiclass")


def _featured(model: TreeModel | BoostedModel, df: DataFrame) -> DataFrame:
    """The input as ``_row`` next to its transformed features."""
    inputs = df.withColumn("_row", F.struct("*"))
    return model.transform.without(model.label).transform(inputs, keep=["_row"])


def _with_predictions(model: TreeModel | BoostedModel, rows: DataFrame, name: str) -> DataFrame:
    """Mean of the models; a row with a missing feature gets NULL."""
    complete = F.lit(True)
    for c in model.features:
        complete = complete & F.col(c).isNotNull()
    rows = rows.withColumn("_complete", complete)
    if isinstance(model, BoostedModel):
        rows = score(model, rows, name)
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in model.features})
    if isinstance(model, BoostedModel):
        return VectorAssembler(inputCols=model.features, outputCol="_features").transform(rows)
    parts = []
    for i, pipeline in enumerate(model.models):
        rows = pipeline.transform(rows.drop("_features"))
        parts.append(F.col(f"_p{i}"))
        rows = rows.withColumnRenamed("_prediction", f"_p{i}")
        if "rawPrediction" in rows.columns:
            rows = rows.drop("rawPrediction")
    total = sum(parts[1:], parts[0]) / len(parts)
    value = total.cast("int") if model.kind == "multiclass" else total
    return rows.withColumn(name, F.when(F.col("_complete"), value))


def predict(model: TreeModel | BoostedModel, df: DataFrame) -> DataFrame:
    """All input columns and ``predicted_<label>``; the transform is applied inside."""
    name = f"predicted_{model.label}"
    return _with_predictions(model, _featured(model, df), name).select("_row.*", name)


def batch_predict(
    model: TreeModel, in_path: str, out_path: str, schema: T.StructType, include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None, compression: str | None = None,
) -> None:
    """JSON lines in, JSON lines with predictions out, compressed if asked for; only the chosen input fields are scored and kept."""
    instances = scan_jsonl(SparkSession.getActiveSession(), in_path, schema)
    write_jsonl(predict(model, select_features(instances, include, exclude)), out_path, compression=compression)


# the trees behind a model
NODES = """
    model int, tree int, weight double, id int, left int, right int, feature int, threshold double, gain double, cover double, prediction double
"""


def tree_nodes(model: TreeModel | BoostedModel) -> DataFrame:
    """Node table of a regressor: (model, tree, weight, id, left, right, feature, threshold, gain, cover, prediction).

    Read back from the parquet files of the saved model.
    """
    if model.kind != "regressor":
        raise ValueError("the node table is given for regressors")
    spark = SparkSession.getActiveSession()
    if isinstance(model, BoostedModel):
        return spark.createDataFrame(nodes_of(model), NODES)
    parts = []
    for i, pipeline in enumerate(model.models):
        path = scratch_path(spark, "trees")
        booster = pipeline.stages[-1]
        booster.write().overwrite().save(path)
        weights = spark.createDataFrame(list(enumerate(booster.treeWeights)), "tree int, weight double")
        node = F.col("nodeData")
        parts.append(
            spark.read.parquet(f"{path}/data").select(
                F.lit(i).alias("model"), F.col("treeID").alias("tree"), node["id"].alias("id"),
                node["leftChild"].alias("left"), node["rightChild"].alias("right"),
                node["split"]["featureIndex"].alias("feature"),
                F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
                node["gain"].alias("gain"), node["rawCount"].cast("double").alias("cover"),
                node["prediction"].alias("prediction"),
            ).join(F.broadcast(weights), "tree")  # one row per tree
        )
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    return nodes


def feature_importance(model: TreeModel) -> DataFrame:
    """Per feature: number of splits, mean gain and mean cover, by gain; unused features have 0 splits."""
    spark = SparkSession.getActiveSession()
    names = spark.createDataFrame(list(enumerate(model.features)), "index int, feature string")
    used = tree_nodes(model).filter("left >= 0").groupBy(F.col("feature").alias("index")).agg(
        F.count(F.lit(1)).alias("importance_weight"), F.avg("gain").alias("importance_gain"),
        F.avg("cover").alias("importance_cover"),
    )
    filled = names.join(used, "index", "left").select("feature", *[
        F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("importance_weight", "importance_gain", "importance_cover")
    ])
    return filled.orderBy(F.desc("importance_gain"), "feature")


def _leaf_paths(nodes: list) -> tuple[list, float]:
    """Every leaf as (value, {feature: (low, high, share)}) and the expected prediction of the model.

    A row satisfies a feature's part of the path when low < x <= high; ``share`` is the fraction of
    training rows that pass the path's splits on that feature.
    """
    trees: dict[tuple, dict] = {}
    for r in nodes:
        trees.setdefault((r["model"], r["tree"]), {})[r["id"]] = r
    count = len({m for m, _ in trees})
    leaves, baseline = [], 0.0
    for tree in trees.values():
        stack = [(tree[0], {}, 1.0)]
        while stack:
            node, path, reach = stack.pop()
            if node["left"] < 0:
                value = node["prediction"] * node["weight"] / count
                leaves.append((value, path))
                baseline += value * reach
                continue
            low, high, share = path.get(node["feature"], (-math.inf, math.inf, 1.0))
            for child, bounds in (
                (tree[node["left"]], (low, min(high, node["threshold"]))),
                (tree[node["right"]], (max(low, node["threshold"]), high)),
            ):
                part = child["cover"] / node["cover"]
                stack.append((child, {**path, node["feature"]: (*bounds, share * part)}, reach * part))
    return leaves, baseline


def _attributions(x: np.ndarray, leaves: list) -> np.ndarray:
    """Path-dependent Shapley values of every row (rows, features).

    For a leaf with d features on its path, feature i gains value * (one_i - share_i) times the sum over
    the sizes s of coalitions of the others, weighted s!(d-s-1)!/d!. The coalition sums are the
    coefficients of the product of (share_j + one_j t) over the other features j.
    """
    result = np.zeros_like(x)
    for value, path in leaves:
        if not path:
            continue
        used, d = list(path), len(path)
        one = {f: ((x[:, f] > low) & (x[:, f] <= high)).astype("float64") for f, (low, high, _) in path.items()}
        weight = [math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)]
        for i in used:
            sums = [np.ones(len(x))]
            for j in used:
                if j == i:
                    continue
                share = path[j][2]
                grown = [s * share for s in sums] + [np.zeros(len(x))]
                for s in range(len(sums)):
                    grown[s + 1] = grown[s + 1] + sums[s] * one[j]
                sums = grown
            result[:, i] += value * (one[i] - path[i][2]) * sum(w * s for w, s in zip(weight, sums))
    return result


def _explained(model: TreeModel, df: DataFrame) -> tuple[DataFrame, float]:
    leaves, baseline = _leaf_paths(tree_nodes(model).collect())  # a model's nodes: trees x 2^depth
    shared = SparkSession.getActiveSession().sparkContext.broadcast(leaves)

    @F.pandas_udf("array<double>")
    def attribute(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype="object")
        return pd.Series(list(_attributions(np.stack(features.to_numpy()).astype("float64"), shared.value)))

    name = f"predicted_{model.label}"
    scored = _with_predictions(model, _featured(model, df), name)
    return scored.withColumn("_attributions", F.when(F.col("_complete"), attribute(vector_to_array("_features")))), baseline


def _pairs(model: TreeModel) -> Column:
    names = F.array(*[F.lit(f) for f in model.features])
    return F.zip_with(
        names, "_attributions", lambda f, a: F.struct(F.abs(a).alias("size"), f.alias("feature"), a.alias("attribution"))
    )


def explain_predict(model: TreeModel, df: DataFrame, top_k: int = 5) -> DataFrame:
    """All input columns, the prediction, the baseline and the k largest (feature, attribution) pairs.

    All attributions and the baseline add up to the prediction. A row with a missing feature has NULL for its
    prediction and its attributions.
    """
    scored, baseline = _explained(model, df)
    top = F.transform(
        F.slice(F.sort_array(_pairs(model), asc=False), 1, top_k),
        lambda p: F.struct(p["feature"].alias("feature"), p["attribution"].alias("attribution")),
    )
    return scored.select(
        "_row.*", f"predicted_{model.label}", F.lit(baseline).alias("baseline"), top.alias("top_feature_attributions")
    )


def global_explain(model: TreeModel, df: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    scored, _ = _explained(model, df)
    pairs = scored.select(F.explode(_pairs(model)).alias("p"))
    return pairs.groupBy(F.col("p.feature").alias("feature")).agg(F.avg("p.size").alias("attribution")).orderBy(
        F.desc("attribution"), "feature"
    )
