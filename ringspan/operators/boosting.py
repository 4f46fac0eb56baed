"""Boosted trees on histograms: softmax or squared loss, leaf-wise growth, penalties, feature and row fractions.

Rows are stored once with a byte per feature, the number of the quantile bin. A pass over them adds up gradients per
open node, feature and bin inside every partition; the histograms are summed by an aggregate, which also finds the best
bin of every feature, and the driver sees one split per open node. All trees of a round, one per class, grow in the same
passes, a level each. A node's gain hangs on its own rows alone, so the nodes of all levels can be measured first and
the ``num_leaves`` of leaf-wise growth chosen among them afterwards: the tree is that of splitting the best leaf each time.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import partitions_for, store
from .features import FittedTransform

#: Rounds after which the running scores are stored, so that what a lost executor held is not recomputed from the start.
STORED_ROUNDS = 10
#: Rows that are worth a partition of their own.
PARTITION_ROWS = 20_000


@dataclass
class Tree:
    """Nodes by number, 0 the root: the feature and bin of the split (rows at or below go left), -1 for a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def add(self, value: float, cover: float) -> int:
        for name, x in zip(("feature", "bin", "left", "right", "value", "gain", "cover"), (-1, 0, -1, -1, value, 0.0, cover), strict=True):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every row of bins."""
        feature, cut, left, right = (np.array(getattr(self, n)) for n in ("feature", "bin", "left", "right"))
        at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            here = at[rows]
            at[rows] = np.where(codes[rows, feature[here]] <= cut[here], left[here], right[here])
        return at

    def chosen(self, num_leaves: int) -> Tree:
        """The tree that splits the leaf of largest gain each time until it has ``num_leaves``."""
        made, leaves = Tree(value=[self.value[0]], cover=[self.cover[0]]), 1
        heap = [(-self.gain[0], 0, 0)] if self.feature[0] >= 0 else []
        while heap and leaves < num_leaves:
            _, old, new = heapq.heappop(heap)
            made.feature[new], made.bin[new], made.gain[new] = self.feature[old], self.bin[old], self.gain[old]
            for side in ("left", "right"):
                child = getattr(self, side)[old]
                at = made.add(self.value[child], self.cover[child])
                getattr(made, side)[new] = at
                if self.feature[child] >= 0:
                    heapq.heappush(heap, (-self.gain[child], child, at))
            leaves += 1
        return made


@dataclass
class BoostedModel:
    """A fitted transform, the bins of its features, and the trees of every round, one per class."""

    label: str
    features: list[str]
    transform: FittedTransform
    cuts: list[list[float]]
    base: list[float]
    rounds: list[list[Tree]]
    kind: str = "multiclass"
    history: list[dict] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(self.cuts)], 1).astype(np.uint8)

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """(rows, classes): the sum of all trees."""
        total = np.tile(np.array(self.base), (len(codes), 1))
        for trees in self.rounds:
            total += _outputs(trees, codes)
        return total

    def save(self, path: str) -> None:
        state = {n: getattr(self, n) for n in ("label", "features", "cuts", "base", "kind", "history")}
        state |= {"rounds": [[vars(t) for t in trees] for trees in self.rounds], "transform": self.transform.to_json(), "boosted": True}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, path: str) -> BoostedModel:
        state = json.loads(SparkSession.getActiveSession().read.text(path).first()[0])
        rounds = [[Tree(**t) for t in trees] for trees in state["rounds"]]
        transform = FittedTransform.from_json(state["transform"])
        return cls(state["label"], state["features"], transform, state["cuts"], state["base"], rounds, state["kind"], state["history"])


def _outputs(trees: Sequence[Tree], codes: np.ndarray) -> np.ndarray:
    return np.stack([np.array(t.value)[t.leaves(codes)] for t in trees], 1)


def gradients(scores: np.ndarray, label: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by the scores, (rows, classes) each."""
    if kind == "regressor":
        return scores - label[:, None], np.ones_like(scores)
    p = _softmax(scores)
    return p - (label[:, None] == np.arange(scores.shape[1])[None, :]), np.maximum(p * (1.0 - p), 1e-16)


def _softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(1, keepdims=True))
    return grown / grown.sum(1, keepdims=True)


def losses(scores: np.ndarray, label: np.ndarray, kind: str) -> np.ndarray:
    """The loss of every row: squared error, or the logarithm of the class's share."""
    if kind == "regressor":
        return (scores[:, 0] - label) ** 2
    return -np.log(np.maximum(_softmax(scores)[np.arange(len(label)), label.astype(int)], 1e-300))


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_bin(histogram: np.ndarray, l1: float, l2: float, min_rows: float) -> tuple[float, int, np.ndarray, np.ndarray]:
    """(gain, bin, left, all) of a feature's histogram (bins, 3) of gradients, second derivatives and rows.

    The gain is what the split takes off the loss; -1 if no bin leaves ``min_rows`` on either side.
    """
    before, total = histogram.cumsum(0), histogram.sum(0)
    worth = lambda s: _shrunk(s[..., 0], l1) ** 2 / np.maximum(s[..., 1] + l2, 1e-12)
    gain = worth(before) + worth(total - before) - worth(total)
    gain[(before[:, 2] < min_rows) | (total[2] - before[:, 2] < min_rows)] = -1.0
    at = int(np.round(gain, 9).argmax())
    return float(gain[at]) / 2, at, before[at], total


def _leaf(stats: np.ndarray, l1: float, l2: float, rate: float) -> float:
    return float(-rate * _shrunk(stats[0], l1) / max(stats[1] + l2, 1e-12))


def _codes(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def _binned(rows: DataFrame, label: str, features: Sequence[str], max_bins: int) -> tuple[list[list[float]], DataFrame]:
    """The inner bounds of every feature's bins, and stored (label, codes, held, key)."""
    shares = [i / max_bins for i in range(1, max_bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 10_000).alias(f"q{i}") for i, c in enumerate(features)]).first()
    cuts = [sorted(set(found[f"q{i}"] or [])) for i in range(len(features))]

    def place(batches):
        for batch in batches:
            x = batch[[f"x{i}" for i in range(len(cuts))]].to_numpy("float64")
            codes = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], 1).astype(np.uint8)
            yield pd.DataFrame({"label": batch["label"], "codes": [c.tobytes() for c in codes], "held": batch["held"], "key": batch["key"]})

    columns = [F.col(f"`{c}`").cast("double") for c in features]
    rows = rows.select(
        F.col(f"`{label}`").alias("label"), F.col("_held_out").alias("held"), F.xxhash64(*columns, F.col(f"`{label}`")).alias("key"),
        *[c.alias(f"x{i}") for i, c in enumerate(columns)],
    )
    # A partition sends its histograms in every pass, which few rows are not worth.
    spread = rows.repartition(min(partitions_for(rows), rows.count() // PARTITION_ROWS + 1))
    return cuts, store(spread.mapInPandas(place, "label double, codes binary, held boolean, key long"), "binned-rows")


def _histograms(batches, trees, wanted, chosen, kind, bins, sampled):
    """(tree, node, sums) of a partition's rows: gradients, second derivatives and rows per chosen feature and bin."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        keep = sampled(np.ascontiguousarray(batch["key"].to_numpy()))
        batch = batch[keep]
        if batch.empty:
            continue
        codes = _codes(batch["codes"])
        g, h = gradients(np.stack(batch["scores"].to_numpy()), batch["label"].to_numpy(), kind)
        for k, tree in enumerate(trees):
            if not wanted[k]:
                continue
            at = tree.leaves(codes)
            slot = np.full(len(tree.feature), -1)
            slot[wanted[k]] = np.arange(len(wanted[k]))
            rows = np.flatnonzero(slot[at] >= 0)
            base, size = slot[at[rows]] * bins, len(wanted[k]) * bins
            sums = np.empty((len(wanted[k]), len(chosen[k]), bins, 3))
            for i, f in enumerate(chosen[k]):
                index = base + codes[rows, f]
                for j, w in enumerate((g[rows, k], h[rows, k], None)):
                    sums[:, i, :, j] = np.bincount(index, w, size).reshape(-1, bins)
            for node, one in zip(wanted[k], sums, strict=True):
                total[k, node] = total[k, node] + one if (k, node) in total else one
    if total:
        yield pd.DataFrame([(*key, one.ravel()) for key, one in total.items()], columns=["tree", "node", "sums"])


def _sampler(share: float, seed: int, n: int):
    """Which rows, by key, the trees of round ``n`` see."""
    salt, limit = np.uint64(np.random.SeedSequence([seed, n]).generate_state(1, np.uint64)[0]), int(share * (1 << 32))

    def chosen(key: np.ndarray) -> np.ndarray:
        z = (key.view(np.uint64) ^ salt) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (z ^ (z >> np.uint64(32))) >> np.uint64(32) < limit

    return chosen


def _splits(state: DataFrame, trees, wanted, chosen, kind, bins, sampled, l1, l2, min_rows) -> dict:
    """{(tree, node): (gain, feature, bin, left, all)}: one row per open node comes back."""
    trees = [Tree(**vars(t)) for t in trees]
    parts = state.mapInPandas(lambda b: _histograms(b, trees, wanted, chosen, kind, bins, sampled), "tree int, node int, sums array<double>")
    summed = parts.groupBy("tree", "node").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))

    @F.pandas_udf("gain double, feature int, bin int, part array<double>, total array<double>")
    def best(tree: pd.Series, sums: pd.Series) -> pd.DataFrame:
        rows = []
        for k, one in zip(tree, sums, strict=True):
            found = [best_bin(x, l1, l2, min_rows) for x in np.asarray(one).reshape(len(chosen[k]), bins, 3)]
            i = int(np.round([f[0] for f in found], 9).argmax())
            rows.append((found[i][0], chosen[k][i], *found[i][1:]))
        return pd.DataFrame(rows, columns=["gain", "feature", "bin", "part", "total"])

    found = summed.select("tree", "node", best("tree", "sums").alias("b"))
    return {
        (r["tree"], r["node"]): (r["b"]["gain"], r["b"]["feature"], r["b"]["bin"], np.array(r["b"]["part"]), np.array(r["b"]["total"]))
        for r in found.collect()
    }


def fit_boosted(
    rows: DataFrame, label: str, features: Sequence[str], transform: FittedTransform, kind: str = "multiclass", max_iter: int = 20,
    max_depth: int = 5, num_leaves: int = 31, learn_rate: float = 0.1, feature_fraction: float = 1.0, subsample: float = 1.0,
    l1_reg: float = 0.0, l2_reg: float = 0.0, min_rows: int = 1, min_gain: float = 1e-9, max_bins: int = 64, early_stop: bool = False,
    min_rel_progress: float = 0.0, track_history: bool = True, seed: int = 0,
) -> BoostedModel:
    """Trees over prepared rows (features, label, ``_held_out``); rows held out are only measured.

    Equal rows are sampled, and held out, together, whatever the partitioning. A pass per level of a round, one more
    for its losses; histograms hold classes x open nodes x features x bins numbers at most.
    """
    if not 2 <= max_bins <= 256:
        raise ValueError("max_bins is from 2 to 256")
    cuts, state = _binned(rows, label, features, max_bins)
    if kind == "multiclass":
        counts = {int(r["label"]): r["count"] for r in state.filter("not held").groupBy("label").count().collect()}  # one per class
        if not counts or min(counts) < 0:
            raise ValueError("classes are integers from 0, with rows to train on")
        total = sum(counts.values())
        highest = int(state.agg(F.max("label")).first()[0])
        base = [float(np.log(max(counts.get(k, 0), 0.5) / total)) for k in range(highest + 1)]
    else:
        mean = state.filter("not held").agg(F.avg("label")).first()[0]
        if mean is None:
            raise ValueError("no rows to train on")
        base = [float(mean)]
    model = BoostedModel(label, list(features), transform, cuts, base, [], kind)
    state, kept = state.withColumn("scores", F.array(*[F.lit(b) for b in base])), None
    for n in range(1, max_iter + 1):
        rng = np.random.default_rng([seed, n])
        some = max(1, round(feature_fraction * len(features)))
        chosen = [sorted(rng.permutation(len(features))[:some].tolist()) for _ in base]
        sampled = _sampler(subsample, seed, n)
        trees, open_ = [Tree() for _ in base], [[0] for _ in base]
        train = state.filter("not held")
        for depth in range(max_depth):
            if not any(open_):
                break
            found = _splits(train, trees, open_, chosen, kind, max_bins, sampled, l1_reg, l2_reg, min_rows)
            new: list[list[int]] = [[] for _ in base]
            for (k, node), (gain, feature, at, part, all_) in sorted(found.items()):
                tree = trees[k]
                if depth == 0:
                    tree.value[0], tree.cover[0] = _leaf(all_, l1_reg, l2_reg, learn_rate), float(all_[2])
                if gain <= min_gain:
                    continue
                tree.feature[node], tree.bin[node], tree.gain[node] = feature, at, gain
                for side, stats in (("left", part), ("right", all_ - part)):
                    child = tree.add(_leaf(stats, l1_reg, l2_reg, learn_rate), float(stats[2]))
                    getattr(tree, side)[node] = child
                    new[k].append(child)
            open_ = new
        trees = [t.chosen(num_leaves) for t in trees]
        model.rounds.append(trees)

        def further(batches, trees=trees):
            for batch in batches:
                if len(batch):
                    batch["scores"] = list(np.stack(batch["scores"].to_numpy()) + _outputs(trees, _codes(batch["codes"])))
                yield batch

        grown = state.mapInPandas(further, state.schema)
        if n % STORED_ROUNDS == 0:
            grown, spare = store(grown, "boosting-scores"), None
        else:
            grown = spare = grown.persist()
        if track_history or early_stop:
            model.history.append({"iteration": n, **_loss(grown, kind)})
        else:
            grown.count()
        if kept is not None:
            kept.unpersist()
        state, kept = grown, spare
        watched = [h["eval_loss"] for h in model.history if h["eval_loss"] is not None]
        if early_stop and len(watched) > 1 and watched[-2] - watched[-1] < min_rel_progress * watched[-2]:
            break
    if kept is not None:
        kept.unpersist()
    return model


def _loss(state: DataFrame, kind: str) -> dict:
    @F.pandas_udf("double")
    def loss(scores: pd.Series, label: pd.Series) -> pd.Series:
        return pd.Series(losses(np.stack(scores.to_numpy()), label.to_numpy(), kind)) if len(scores) else pd.Series([], dtype="float64")

    found = {r["held"]: r["loss"] for r in state.groupBy("held").agg(F.avg(loss("scores", "label")).alias("loss")).collect()}
    return {"loss": found.get(False), "eval_loss": found.get(True)}


def score(model: BoostedModel, rows: DataFrame, name: str) -> DataFrame:
    """Rows of transformed features with their prediction; NULL where a feature is missing."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def predicted(x: pd.Series) -> pd.Series:
        out, known = np.full(len(x), np.nan), x.notna().to_numpy()
        if known.any():
            scores = shared.value.scores(shared.value.bins(np.stack(x[known].to_numpy()).astype("float64")))
            out[known] = scores[:, 0] if shared.value.kind == "regressor" else scores.argmax(1)
        return pd.Series(out).where(pd.Series(known), None)

    columns = [F.col(f"`{c}`").cast("double") for c in model.features]
    complete = F.lit(True)
    for c in columns:
        complete = complete & c.isNotNull()
    value = predicted(F.when(complete, F.array(*columns)))
    return rows.withColumn(name, F.when(complete, value.cast("int") if model.kind == "multiclass" else value))


def nodes_of(model: BoostedModel) -> list[tuple]:
    """(model, tree, weight, id, left, right, feature, threshold, gain, cover, prediction) of a regressor's nodes.

    The mean that the trees start from is a tree of one leaf.
    """
    rows = [(0, 0, 1.0, 0, -1, -1, -1, None, 0.0, 1.0, float(model.base[0]))]
    for n, (tree,) in enumerate(model.rounds, 1):
        for i, f in enumerate(tree.feature):
            cut = model.cuts[f][tree.bin[i]] if f >= 0 else None
            rows.append((0, n, 1.0, i, tree.left[i], tree.right[i], f, cut, tree.gain[i], tree.cover[i], tree.value[i]))
    return rows
