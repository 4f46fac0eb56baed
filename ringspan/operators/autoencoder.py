"""Autoencoder on numeric columns: distributed training, reconstruction, trials, training log."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, partitions_for
from .features import FeatureTransform, FittedTransform, standard_scaler

ACTIVATIONS = ("relu", "sigmoid", "tanh", "linear")
OPTIMIZERS = ("adam", "sgd")


def _activate(name: str, z: np.ndarray) -> np.ndarray:
    if name == "relu":
        return np.maximum(z, 0.0)
    if name == "sigmoid":
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
    return np.tanh(z) if name == "tanh" else z


def _slope(name: str, a: np.ndarray) -> np.ndarray:
    """Derivative of the activation, from its output."""
    if name == "relu":
        return (a > 0).astype(a.dtype)
    if name == "sigmoid":
        return a * (1.0 - a)
    return 1.0 - a * a if name == "tanh" else np.ones_like(a)


@dataclass(frozen=True)
class Network:
    """Layer widths and activations; weights travel as one flat vector."""

    widths: tuple[int, ...]
    activation: str
    output_activation: str = "linear"

    def layers(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        found, at = [], 0
        for a, b in itertools.pairwise(self.widths):
            found.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return found

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        parts = []
        for a, b in itertools.pairwise(self.widths):
            parts += [rng.normal(0.0, np.sqrt(2.0 / (a + b)), a * b), np.zeros(b)]
        return np.concatenate(parts)

    def outputs(self, flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """The input and every layer's output."""
        values, layers = [x], self.layers(flat)
        for i, (w, b) in enumerate(layers):
            name = self.output_activation if i == len(layers) - 1 else self.activation
            values.append(_activate(name, values[-1] @ w + b))
        return values

    def gradient(self, flat: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Summed squared error per feature of a batch, and the gradient of its mean."""
        values, layers = self.outputs(flat, x), self.layers(flat)
        error = values[-1] - x
        delta = 2.0 * error / error.size * _slope(self.output_activation, values[-1])
        parts = []
        for i in range(len(layers) - 1, -1, -1):
            parts = [(values[i].T @ delta).ravel(), delta.sum(axis=0), *parts]
            if i:
                delta = (delta @ layers[i][0].T) * _slope(self.activation, values[i])
        return float((error**2).mean(axis=1).sum()), np.concatenate(parts)


@dataclass
class Trial:
    """What is fitted how, and how far it has come."""

    network: Network
    optimizer: str = "adam"
    lr: float = 0.01
    batch: int = 32
    max_iter: int = 10
    early_stop: bool = True
    min_rel_progress: float = 0.01
    held_out: float = 0.2
    seed: int = 0
    weights: np.ndarray | None = None
    best: np.ndarray | None = None
    history: list[dict] = field(default_factory=list)
    stopped: bool = False

    def watched(self) -> list[float]:
        """The held-out losses so far, or those of the training rows if none are held out."""
        return [h["eval_loss"] if h["eval_loss"] is not None else h["loss"] for h in self.history]


class _Steps:
    """Mini-batch steps of one trial over one partition."""

    def __init__(self, trial: Trial):
        self.trial, self.weights = trial, trial.weights.copy()
        self.first, self.second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        self.rows, self.loss, self.step = 0, 0.0, 0

    def take(self, data: np.ndarray) -> None:
        trial = self.trial
        for start in range(0, len(data), trial.batch):
            part = data[start : start + trial.batch]
            error, grad = trial.network.gradient(self.weights, part)
            self.rows, self.loss, self.step = self.rows + len(part), self.loss + error, self.step + 1
            if trial.optimizer == "sgd":
                self.weights -= trial.lr * grad
                continue
            self.first = 0.9 * self.first + 0.1 * grad
            self.second = 0.999 * self.second + 0.001 * grad * grad
            self.weights -= trial.lr * (self.first / (1 - 0.9**self.step)) / (np.sqrt(self.second / (1 - 0.999**self.step)) + 1e-7)


def _train_partition(batches, trials: dict[int, Trial]):
    """All trials over one partition, read once; yields the weights of each with its row count and loss."""
    steps = {i: _Steps(t) for i, t in trials.items()}
    for batch in batches:
        if len(batch):
            data, share = np.stack(batch["x"].to_numpy()), batch["u"].to_numpy()
            for i, t in trials.items():
                steps[i].take(data[share >= t.held_out])
    done = {i: s for i, s in steps.items() if s.rows}
    if done:
        yield pd.DataFrame({
            "trial": list(done), "n": [float(s.rows) for s in done.values()], "loss": [s.loss for s in done.values()],
            "w": [s.weights for s in done.values()],
        })


def _measure_partition(batches, trials: dict[int, Trial]):
    """The held-out rows and loss of all trials over one partition."""
    for batch in batches:
        if len(batch):
            data, share = np.stack(batch["x"].to_numpy()), batch["u"].to_numpy()
            found = []
            for i, t in trials.items():
                x = data[share < t.held_out]
                if len(x):
                    error = t.network.outputs(t.weights, x)[-1] - x
                    found.append((i, len(x), float((error**2).mean(axis=1).sum())))
            yield pd.DataFrame(found, columns=["trial", "n", "loss"])


@dataclass
class AutoencoderModel:
    """Weights, the scaler of the training rows, the training log and fitted thresholds."""

    cols: list[str]
    network: Network
    weights: np.ndarray
    scaler: FittedTransform
    history: list[dict] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def scaled(self) -> Column:
        """The model's input as an array column."""
        return F.array(*self.scaler.columns(self.cols))

    def reconstructed(self, x: Column) -> Column:
        network, weights = self.network, self.weights

        @F.pandas_udf("array<double>")
        def forward(rows: pd.Series) -> pd.Series:
            known = rows.notna().to_numpy()
            out = [None] * len(rows)
            if known.any():
                result = network.outputs(weights, np.stack(rows[known].to_numpy()).astype("float64"))[-1]
                for i, values in zip(np.flatnonzero(known), result):
                    out[i] = values
            return pd.Series(out, dtype="object")

        return forward(x)

    def save(self, path: str) -> None:
        state = {
            "cols": self.cols, "widths": self.network.widths, "activation": self.network.activation,
            "output_activation": self.network.output_activation, "weights": [float(w) for w in self.weights],
            "scaler": self.scaler.to_json(), "history": self.history, "thresholds": self.thresholds,
        }
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, path: str) -> AutoencoderModel:
        state = json.loads(SparkSession.getActiveSession().read.text(path).first()[0])
        network = Network(tuple(state["widths"]), state["activation"], state["output_activation"])
        return cls(state["cols"], network, np.array(state["weights"]), FittedTransform.from_json(state["scaler"]),
                   state["history"], state["thresholds"])


def _training_rows(df: DataFrame, cols: Sequence[str], scaler: FittedTransform) -> DataFrame:
    """Scaled arrays of the complete rows, spread evenly and kept, so that iterations do not recompute them."""
    complete = df.dropna("any", subset=list(cols))
    return cut_lineage(complete.select(F.array(*scaler.columns(cols)).alias("x")).repartition(partitions_for(complete)))


def fit_autoencoder(
    df: DataFrame, cols: Sequence[str], hidden: Sequence[int] = (8, 4, 2, 4, 8), activation: str = "relu",
    optimizer: str = "adam", lr: float = 0.01, batch: int = 32, max_iter: int = 10, early_stop: bool = True,
    min_rel_progress: float = 0.01, held_out: float = 0.2, output_activation: str = "linear", seed: int = 0,
    rows: DataFrame | None = None, scaler: FittedTransform | None = None,
) -> AutoencoderModel:
    """Parameter averaging: every partition runs mini-batch steps from the current weights, and their
    row-weighted mean, formed by an aggregate, starts the next iteration.

    Only the weights, a few hundred numbers, pass through the driver. ``rows`` and ``scaler`` may be
    shared between several fits. Training stops early when the held-out loss no longer improves.
    """
    trial = _trial(
        cols, hidden, activation, output_activation, optimizer=optimizer, lr=lr, batch=batch, max_iter=max_iter, early_stop=early_stop,
        min_rel_progress=min_rel_progress, held_out=held_out, seed=seed,
    )
    scaler = scaler or FeatureTransform([standard_scaler(c) for c in cols]).fit(df)
    unknown = [c for c in cols if scaler.stats[c]["mean"] is None]
    if unknown:
        raise ValueError(f"no complete rows to train on: no values in {unknown}")
    rows = rows if rows is not None else _training_rows(df, cols, scaler)
    _fit_trials(rows, [trial])
    return AutoencoderModel(list(cols), trial.network, trial.best, scaler, trial.history)


def _rungs(trials: int, max_iter: int, halving: int | None) -> dict[int, int]:
    """{iteration: trials that go on behind it}: budgets grow as the trials grow fewer."""
    found, left = {}, trials
    if halving and halving > 1:
        steps = max(0, math.ceil(math.log(trials, halving) - 1e-9))
        for i in range(steps, 0, -1):
            left = -(-left // halving)
            found[max(1, max_iter // halving**i)] = left
    return found


def _fit_trials(rows: DataFrame, trials: Sequence[Trial], halving: int | None = None) -> None:
    """Fits all trials in the same passes, two per iteration: one that trains and one that measures.

    A trial ends with its own iterations, when it no longer improves, or at a rung of successive halving, behind which
    only the best go on. Only weights, a few hundred numbers per trial and partition, are merged.
    """
    # Held out by row content: equal rows fall on the same side, whatever the partitioning.
    rows = rows.select("x", (F.pmod(F.xxhash64("x"), F.lit(10_000)) / 10_000).alias("u"))
    for t in trials:
        t.weights = t.best = t.network.start(t.seed)
    most = max((t.max_iter for t in trials), default=0)
    rungs = _rungs(len(trials), most, halving)
    for iteration in range(1, most + 1):
        live = {i: t for i, t in enumerate(trials) if not t.stopped}
        if not live:
            return
        trained = rows.mapInPandas(_bound(_train_partition, live), "trial int, n double, loss double, w array<double>")
        merged = {r["trial"]: r for r in trained.groupBy("trial").agg(
            Summarizer.mean(array_to_vector("w"), F.col("n")).alias("w"), F.sum("loss").alias("loss"), F.sum("n").alias("n")
        ).collect()}  # one row per trial
        if not merged:
            raise ValueError("no complete rows to train on")
        for i, t in live.items():
            t.weights = np.array(merged[i]["w"].toArray()) if i in merged else t.weights
        measured = {}
        if any(t.held_out for t in live.values()):
            held = rows.mapInPandas(_bound(_measure_partition, live), "trial int, n long, loss double")
            measured = {r["trial"]: r["loss"] / r["n"] for r in held.groupBy("trial").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss")).collect()}
        for i, t in live.items():
            t.history.append({"iteration": iteration, "loss": merged[i]["loss"] / merged[i]["n"] if i in merged else None, "eval_loss": measured.get(i)})
            watched = t.watched()
            if watched[-1] is not None and watched[-1] <= min(w for w in watched if w is not None):
                t.best = t.weights
            slow = len(watched) > 1 and watched[-2] - watched[-1] < t.min_rel_progress * watched[-2]
            t.stopped = iteration >= t.max_iter or (t.early_stop and slow)
        if iteration in rungs:
            ranked = sorted((i for i in live), key=lambda i: min(trials[i].watched()))
            for i in ranked[rungs[iteration]:]:
                trials[i].stopped = True


def _bound(train, trials: dict[int, Trial]):
    return lambda batches: train(batches, trials)


def fit_pca_reconstructor(df: DataFrame, cols: Sequence[str], k: int) -> AutoencoderModel:
    """The linear counterpart: k principal components and back. Same model interface."""
    scaler = FeatureTransform([standard_scaler(c) for c in cols]).fit(df)
    complete = df.dropna("any", subset=list(cols))
    vectors = complete.select(array_to_vector(F.array(*scaler.columns(cols))).alias("x"))
    pc = PCA(k=k, inputCol="x", outputCol="y").fit(vectors).pc.toArray()
    weights = np.concatenate([pc.ravel(), np.zeros(k), pc.T.ravel(), np.zeros(len(cols))])
    return AutoencoderModel(list(cols), Network((len(cols), k, len(cols)), "linear"), weights, scaler)


@dataclass
class Search:
    """All trials of a search; ``model()`` gives the best one or a chosen trial's."""

    trials: list[dict]
    models: dict[int, AutoencoderModel]

    def model(self, trial_id: int | None = None) -> AutoencoderModel:
        if trial_id is None:
            trial_id = next(t["trial_id"] for t in self.trials if t["is_best"])
        return self.models[trial_id]

    def save(self, path: str) -> None:
        """The trial table, and every model that was fitted below its trial's number."""
        trial_info(self).coalesce(1).write.mode("overwrite").parquet(f"{path}/trials")
        for trial_id, model in self.models.items():
            model.save(f"{path}/models/{trial_id}")

    @classmethod
    def load(cls, path: str) -> Search:
        rows = SparkSession.getActiveSession().read.parquet(f"{path}/trials").orderBy("trial_id").collect()  # one per trial
        trials = [r.asDict() for r in rows]
        return cls(trials, {t["trial_id"]: AutoencoderModel.load(f"{path}/models/{t['trial_id']}") for t in trials if t["loss"] is not None})


def hyperparameter_search(
    df: DataFrame, cols: Sequence[str], grid: Mapping[str, Sequence], num_trials: int = 4, seed: int = 0, halving: int | None = 2, **fixed
) -> Search:
    """Fits candidates of the grid (a seeded choice when there are more than ``num_trials``) on the same rows and split,
    all in the same passes; the objective is the held-out mean squared error.

    By successive halving one in ``halving`` trials goes on behind each rung, and the last one has all iterations; with
    None all have. The passes over the rows are two per iteration, however many trials there are.
    """
    names = list(grid)
    candidates = [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]
    if len(candidates) > num_trials:
        candidates = random.Random(seed).sample(candidates, num_trials)
    scaler = FeatureTransform([standard_scaler(c) for c in cols]).fit(df)
    rows = _training_rows(df, cols, scaler)
    records, live = [], {}
    for trial_id, choice in enumerate(candidates, 1):
        record = {"trial_id": trial_id, "hyperparameters": json.dumps(choice, sort_keys=True), "loss": None,
                  "status": "SUCCEEDED", "is_best": False, "iterations": 0}
        try:
            live[trial_id] = _trial(cols, **{"seed": seed, **fixed, **choice})
        except ValueError as problem:
            record["status"] = f"FAILED: {problem}"
        records.append(record)
    try:
        _fit_trials(rows, list(live.values()), halving)
    except ValueError as problem:
        raise ValueError("no trial succeeded") from problem
    models = {i: AutoencoderModel(list(cols), t.network, t.best, scaler, t.history) for i, t in live.items()}
    for record in records:
        if record["trial_id"] in live:
            trial = live[record["trial_id"]]
            record["loss"], record["iterations"] = min(trial.watched()), len(trial.history)
    done = [t for t in records if t["loss"] is not None]
    if not done:
        raise ValueError("no trial succeeded")
    min(done, key=lambda t: t["loss"])["is_best"] = True
    return Search(records, models)


def _trial(cols: Sequence[str], hidden: Sequence[int] = (8, 4, 2, 4, 8), activation: str = "relu", output_activation: str = "linear", **settings) -> Trial:
    """A trial of the settings of ``fit_autoencoder``."""
    trial = Trial(Network((len(cols), *hidden, len(cols)), activation, output_activation), **settings)
    if activation not in ACTIVATIONS or output_activation not in ACTIVATIONS:
        raise ValueError(f"activation is one of {ACTIVATIONS}")
    if trial.optimizer not in OPTIMIZERS:
        raise ValueError(f"optimizer is one of {OPTIMIZERS}")
    return trial


def trial_info(search: Search) -> DataFrame:
    """One row per trial; ``iterations`` says where it stopped."""
    schema = "trial_id int, hyperparameters string, loss double, status string, is_best boolean, iterations int"
    rows = [tuple(t[n] for n in ("trial_id", "hyperparameters", "loss", "status", "is_best", "iterations")) for t in search.trials]
    return SparkSession.getActiveSession().createDataFrame(rows, schema)


def training_info(model) -> DataFrame:
    """One row per iteration, in order, of any model that keeps a training log."""
    rows = [(h["iteration"], h["loss"], h["eval_loss"]) for h in model.history]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "iteration int, loss double, eval_loss double").orderBy("iteration")
