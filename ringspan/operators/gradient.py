"""Spark ML's gradient-boosted regression trees, grown on blocks of binned rows.

``GBTRegressor`` keeps every row as an object and reads all of them once a level of a tree: rows that do not fit into memory
are read back object by object each time. Here a block is one stored row of some thousand rows, with a number of few bytes
per feature, the quantile bin, and the residual of the trees so far; numpy adds up counts and residuals per open node,
feature and bin, and the sums of all blocks are one row per node. Of two children only the one with fewer rows is added
up, the other is what is left of its parent. A tree's end writes the next residuals, and in the same pass the losses and the
sums of the next tree's root, so that a tree of depth d takes d passes.

The method is Spark's: candidate thresholds from the quantiles of some ten thousand rows, variance as impurity, a row
sample per tree, the first tree on the label and further ones on twice the residual at the learning rate, early stop on the
held-out loss. The result is a ``GBTRegressionModel``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch_path

#: Rows of a block at most, and bytes of its bins.
BLOCK_ROWS, BLOCK_BYTES = 32_768, 1 << 19
#: Numbers of the sums that one pass may hold for open nodes.
PASS_NUMBERS = 4_000_000
#: Share of a node's sum of squares up to which a gain is rounding.
ROUNDING = 1e-12
#: Blocks are written so that a reader's batch, a row group of them, is small.
LAYOUT = {"parquet.block.size": 16 << 20, "parquet.enable.dictionary": "false"}

_BLOCK = pa.schema([("block", pa.int64()), ("held", pa.bool_()), ("codes", pa.binary()), ("residual", pa.binary()), ("sums", pa.list_(pa.float64()))])
_BLOCK_DDL = "block long, held boolean, codes binary, residual binary, sums array<double>"
_SUMS = pa.schema([("node", pa.int32()), ("sums", pa.list_(pa.float64()))])
_SUMS_DDL = "node int, sums array<double>"
_SURVEY = pa.schema([("drawn", pa.float64()), ("held", pa.bool_()), ("n", pa.int64()), ("total", pa.float64()), ("x", pa.list_(pa.float64()))])
_SURVEY_DDL = "drawn double, held boolean, n long, total double, x array<double>"


class Grown:
    """A tree's nodes by number, 0 the root: feature and bin of the split (rows at or below go left), children or -1, and
    count, sum and sum of squares of the rows it was grown on."""

    def __init__(self) -> None:
        self.feature, self.bin, self.left, self.right, self.gain = [-1], [0], [-1], [-1], [-1.0]
        self.stats = [np.zeros(3)]

    def add(self, stats: np.ndarray) -> int:
        for name, x in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("gain", -1.0), ("stats", stats)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    @property
    def leaves(self) -> list[int]:
        return [i for i, f in enumerate(self.feature) if f < 0]

    def value(self, node: int) -> float:
        return float(self.stats[node][1] / self.stats[node][0])

    def routed(self, codes: np.ndarray, rows: np.ndarray, wanted: set[int]) -> dict[int, np.ndarray]:
        """Of ``rows`` those that come to each of the wanted nodes; codes are (features, rows)."""
        found, todo, on_path = {}, [(0, rows)], set(wanted)
        for node in reversed(range(len(self.feature))):
            if self.feature[node] >= 0 and (self.left[node] in on_path or self.right[node] in on_path):
                on_path.add(node)
        while todo:
            node, rows = todo.pop()
            if node not in on_path:
                continue
            if node in wanted:
                found[node] = rows
            if self.feature[node] >= 0:
                low = codes[self.feature[node]].take(rows) <= self.bin[node]
                todo += [(self.left[node], rows[low]), (self.right[node], rows[~low])]
        return found


def candidate_thresholds(values: np.ndarray, most: int) -> list[float]:
    """Up to ``most`` thresholds of a feature's sampled values: between all neighbours, or about equal counts apart."""
    values, counts = np.unique(values, return_counts=True)
    between = (values[:-1] + values[1:]) / 2.0
    if len(between) <= most:
        return between.tolist()
    stride, found = counts.sum() / (most + 1), []
    target, done = stride, int(counts[0])
    for i, n in enumerate(counts[1:].tolist()):
        if abs(done - target) < abs(done + n - target):
            found.append(float(between[i]))
            target += stride
        done += n
    return found


def _sampled(share: float, seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """The rows of a block that a tree sees."""
    if share >= 1.0:
        return np.arange(rows)
    drawn = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, tree, block])).random(rows, np.float32)
    return np.flatnonzero(drawn < share)


def _histogram(codes: np.ndarray, residual: np.ndarray, rows: dict[int, np.ndarray], bins: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of each node the sum of squares and, per feature and bin, the counts and sums of its rows, in one array."""
    nodes = [k for k, r in rows.items() if len(r)]
    if not nodes:
        return
    at = np.concatenate([rows[k] for k in nodes])
    sizes = np.array([len(rows[k]) for k in nodes])
    base = np.repeat(np.arange(len(nodes)) * bins, sizes)
    values = residual.take(at)
    squares = np.add.reduceat(values * values, np.cumsum(sizes) - sizes)
    out = np.empty((len(nodes), len(codes), 2, bins))
    for f, column in enumerate(codes):
        index = base + column.take(at)
        out[:, f, 0] = np.bincount(index, None, len(nodes) * bins).reshape(-1, bins)
        out[:, f, 1] = np.bincount(index, values, len(nodes) * bins).reshape(-1, bins)
    for i, k in enumerate(nodes):
        yield k, np.concatenate([squares[i : i + 1], out[i].ravel()])


def _blocks(batch: pa.RecordBatch, features: int, dtype: str) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    for block, held, codes, residual in zip(*(batch.column(i) for i in range(4)), strict=True):
        if block.is_valid:
            codes = np.frombuffer(codes.as_buffer(), dtype).reshape(features, -1)
            yield block.as_py(), held.as_py(), codes, np.frombuffer(residual.as_buffer(), np.float64)


def _row(block=None, held=None, codes=None, residual=None, sums=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((block, held, codes, residual, sums), _BLOCK, strict=True)], schema=_BLOCK)


class _Next:
    """What the end of a tree adds up, in one array: rows and squared residuals not held and held, each leaf's squares of the
    residuals that it was grown on, and the next root's histogram."""

    def __init__(self, leaves: Sequence[int], features: int, bins: int, share: float, seed: int, tree: int) -> None:
        self.leaves, self.features, self.bins, self.share, self.seed, self.tree = list(leaves), features, bins, share, seed, tree
        self.sums = np.zeros(4 + len(self.leaves) + 1 + features * 2 * bins)

    def root(self, block: int, held: bool, codes: np.ndarray, residual: np.ndarray) -> None:
        """The losses of a block and its share of the root of the next tree."""
        self.sums[2 * held : 2 * held + 2] += len(residual), residual @ residual
        if not held:
            rows = _sampled(self.share, self.seed, self.tree, block, len(residual))
            for _, one in _histogram(codes, residual, {0: rows}, self.bins):
                self.sums[4 + len(self.leaves) :] += one

    def read(self, sums: np.ndarray) -> tuple[list[float | None], np.ndarray, np.ndarray]:
        """(mean losses not held and held, squares by leaf, histogram of the next root) of all blocks' sums."""
        n = 4 + len(self.leaves)
        losses = [float(sums[i + 1] / sums[i]) if sums[i] else None for i in (0, 2)]
        return losses, sums[4:n], _counted(sums[n:], self.features, self.bins)


def _binned(rows: DataFrame, label: str, cuts: list[list[float]], shift: float, dtype: str) -> DataFrame:
    """The blocks of rows (features, label, held), with the label less ``shift`` as residual."""
    features = len(cuts)
    size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (features * np.dtype(dtype).itemsize)))

    def block(parts: list[tuple[np.ndarray, np.ndarray]], number: int, held: bool) -> pa.RecordBatch:
        codes, residual = np.concatenate([p[0] for p in parts], 1), np.concatenate([p[1] for p in parts])
        return _row(number, held, codes.tobytes(), residual.tobytes())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list] = {False: [], True: []}
        for batch in batches:
            x = [batch.column(i).to_numpy() for i in range(features + 1)]
            if not all(np.isfinite(c).all() for c in x):
                raise ValueError("features and labels must be finite")
            codes = np.stack([np.searchsorted(c, v, "left").astype(dtype) for c, v in zip(cuts, x, strict=False)])
            held_rows = batch.column(features + 1).to_numpy(zero_copy_only=False)
            for held in (False, True):
                some = np.flatnonzero(held_rows == held)
                for at in range(0, len(some), size):
                    here = some[at : at + size]
                    waiting[held].append((codes[:, here], x[-1][here] - shift))
                    if sum(len(p[1]) for p in waiting[held]) >= size:
                        yield block(waiting[held], number, held)
                        waiting[held], number = [], number + 1
        for held, parts in waiting.items():
            if parts:
                yield block(parts, number, held)
                number += 1

    return _numbers(rows, label).mapInArrow(place, _BLOCK_DDL)


def _counted(histogram: np.ndarray, features: int, bins: int) -> np.ndarray:
    """A summed histogram with whole counts: Spark's sum of vectors goes by their mean."""
    counts = histogram[1:].reshape(features, 2, bins)[:, 0]
    np.rint(counts, out=counts)
    return histogram


def _total(sums: DataFrame) -> np.ndarray:
    """The sum of all rows' sums: one row."""
    return np.array(sums.agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("s")).first()["s"])


def _histograms(state: DataFrame, tree: Grown, wanted: Sequence[int], features: int, dtype: str, bins: int, sampled: Callable) -> dict[int, np.ndarray]:
    """The histograms of some open nodes over all blocks: one row per node comes back."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, _, codes, residual in _blocks(batch, features, dtype):
                rows = tree.routed(codes, sampled(block, len(residual)), set(wanted))
                for node, one in _histogram(codes, residual, rows, bins):
                    total[node] = total[node] + one if node in total else one
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), _SUMS.field(1).type)], schema=_SUMS)

    found = state.filter("not held").select("block", "held", "codes", "residual").mapInArrow(added, _SUMS_DDL)
    summed = found.groupBy("node").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    return {r["node"]: _counted(np.array(r["sums"]), features, bins) for r in summed.collect()}


def best_split(histogram: np.ndarray, features: int, bins: int) -> tuple[float, int, int, np.ndarray] | None:
    """(gain in variance, feature, bin, count and sum of the left side) of the first best split, or None if none gains."""
    squares, counts, sums = histogram[0], *histogram[1:].reshape(features, 2, bins).swapaxes(0, 1)
    n, total = counts[0].sum(), sums[0].sum()
    left_n, left = counts.cumsum(1)[:, :-1], sums.cumsum(1)[:, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left**2 / left_n + (total - left) ** 2 / (n - left_n) - total**2 / n
    gain = np.where((left_n > 0) & (left_n < n), gain, -1.0)
    if not gain.size:
        return None
    # Splits that part the rows alike differ by rounding; the first of them stands for all.
    f, b = np.unravel_index(int((gain >= gain.max() * (1 - ROUNDING)).argmax()), gain.shape)
    if gain[f, b] <= ROUNDING * max(squares, 0.0):
        return None
    return float(gain[f, b] / n), int(f), int(b), np.array([left_n[f, b], left[f, b]])


def _grown(root: np.ndarray, summed: Callable, depth: int, features: int, bins: int) -> Grown:
    """A tree from its root's histogram; ``summed(tree, nodes)`` gives those of open nodes."""
    tree = Grown()
    shape = lambda h: h[1:].reshape(features, 2, bins)[0].sum(1)
    tree.stats[0] = np.array([*shape(root), root[0]])
    open_ = {0: root}
    for level in range(depth):
        pairs = []
        for node, histogram in sorted(open_.items()):
            split = best_split(histogram, features, bins)
            if split is None:
                continue
            tree.gain[node], tree.feature[node], tree.bin[node], left = split
            sides = [np.array([*x, np.nan]) for x in (left, tree.stats[node][:2] - left)]
            tree.left[node], tree.right[node] = (tree.add(s) for s in sides)
            pairs.append((node, tree.left[node], tree.right[node]) if sides[0][0] <= sides[1][0] else (node, tree.right[node], tree.left[node]))
        if level + 1 == depth or not pairs:
            break
        new = {}
        some = max(1, PASS_NUMBERS // (features * 2 * bins))
        for at in range(0, len(pairs), some):
            new |= summed(tree, [p[1] for p in pairs[at : at + some]])
        for node, few, many in pairs:
            new[many] = open_[node] - new[few]
        open_ = new
        for node, histogram in open_.items():
            tree.stats[node][2] = histogram[0]
    return tree


def _java_tree(spark: SparkSession, tree: Grown, cuts: list[list[float]], factor: float, shift: float, uid: str):
    """The tree as Spark's, its leaves times ``factor`` plus ``shift``; leaves of one prediction are one."""
    jvm, array = spark._jvm.org.apache.spark, spark.sparkContext._gateway.new_array

    def made(node: int):
        n, total, squares = tree.stats[node].tolist()
        if np.isnan(squares):
            squares = 0.0
        stats = array(spark._jvm.double, 3)
        value = factor * total / n + shift
        impurity = max(0.0, factor * factor * (squares - total * total / n) / n)
        stats[0], stats[1], stats[2] = float(n), value * n, (impurity + value * value) * n
        calculator = jvm.mllib.tree.impurity.VarianceCalculator(stats, int(n))
        leaf = lambda: (jvm.ml.tree.LeafNode(value, impurity, calculator), value)
        if tree.feature[node] < 0:
            return leaf()
        (left, a), (right, b) = made(tree.left[node]), made(tree.right[node])
        if a is not None and a == b:
            return leaf()
        split = jvm.ml.tree.ContinuousSplit(tree.feature[node], float(cuts[tree.feature[node]][tree.bin[node]]))
        return jvm.ml.tree.InternalNode(value, impurity, factor * factor * tree.gain[node], left, right, split, calculator), None

    return jvm.ml.regression.DecisionTreeRegressionModel(f"{uid}_tree", made(0)[0], len(cuts))


def _surveyed(rows: DataFrame, label: str, asked: int, seed: int) -> tuple[dict[bool, tuple[int, float]], np.ndarray]:
    """({held: (rows, sum of labels)}, features of ``asked`` rows not held) of rows (features, label, held), in one pass.

    Every row draws a number; a task keeps the rows of the ``asked`` smallest, and so does the whole.
    """
    spark, features = rows.sparkSession, len(rows.columns) - 2

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, TaskContext.get().partitionId()]))
        keys, kept, limit = np.empty(0), np.empty((0, features)), 1.0
        about = {False: [0, 0.0], True: [0, 0.0]}
        for batch in batches:
            x, held = [batch.column(i).to_numpy() for i in range(features + 1)], batch.column(features + 1).to_numpy(zero_copy_only=False)
            for side, here in ((False, ~held), (True, held)):
                about[side][0] += int(here.sum())
                about[side][1] += float(x[-1][here].sum())
            drawn = rng.random(len(held))
            some = np.flatnonzero((drawn < limit) & ~held)
            keys, kept = np.concatenate([keys, drawn[some]]), np.concatenate([kept, np.stack([c[some] for c in x[:-1]], 1)])
            if len(keys) > 2 * asked:
                few = np.argpartition(keys, asked)[:asked]
                keys, kept = keys[few], kept[few]
                limit = keys.max()
        few = np.argsort(keys)[:asked]
        counts = [(side, n, total) for side, (n, total) in about.items() if n]
        held, n, total = zip(*counts, strict=True) if counts else ((), (), ())
        none, m = [None] * len(few), len(counts)
        columns = ([None] * m + keys[few].tolist(), [*held, *none], [*n, *none], [*total, *none], [None] * m + list(kept[few]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SURVEY, strict=True)], schema=_SURVEY)

    path = scratch_path(spark, "boosting-survey")
    _numbers(rows, label).mapInArrow(seen, _SURVEY_DDL).write.parquet(path)
    found = spark.read.schema(_SURVEY_DDL).parquet(path)
    about = found.filter("n is not null").groupBy("held").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    some = found.filter("drawn is not null").orderBy("drawn").limit(asked).select("x").collect()
    discard(spark, path)
    return {r["held"]: (r["n"], r["total"]) for r in about}, np.array([r["x"] for r in some]).reshape(-1, features)


def _numbers(rows: DataFrame, label: str) -> DataFrame:
    columns = [F.col(f"`{c}`").cast("double") for c in rows.columns if c not in ("_held_out", label)]
    return rows.select(*columns, F.col(f"`{label}`"), "_held_out")


def fit_gradient_boosted(
    boosters: Sequence[GBTRegressor], rows: DataFrame, dealt: Callable[[DataFrame, int], DataFrame], early_stop: bool, track_history: bool
) -> list[tuple[GBTRegressionModel, list[dict]]]:
    """(model, history) of each of ``boosters``, which differ in their seeds, over rows (features, label, ``_held_out``).

    They share the bins; ``dealt`` parts blocks by the number of rows. ``track_history`` is of the first. Without it and
    ``early_stop`` the rows held out are not read.
    """
    for gbt in boosters:
        gbt._transfer_params_to_java()  # checks them
    gbt = boosters[0]
    spark, label, features = rows.sparkSession, gbt.getLabelCol(), len(rows.columns) - 2
    watched = early_stop or track_history
    if not watched:
        rows = rows.filter(~F.col("_held_out"))
    asked = max(gbt.getMaxBins() ** 2, 10_000)
    about, values = _surveyed(rows, label, asked, gbt.getSeed())
    if False not in about:
        raise ValueError("no rows to train on")
    if watched and True not in about:
        raise ValueError("no rows are held out to measure on")
    if not gbt.getMaxIter():
        raise ValueError("max_iter is 1 or more")
    trained, shift = about[False][0], about[False][1] / about[False][0]
    bins = min(gbt.getMaxBins(), trained)
    cuts = [candidate_thresholds(column, bins - 1) for column in values.T]
    bins = max(2, *(len(c) + 1 for c in cuts))
    layout = features, "uint8" if bins <= 256 else "uint16" if bins <= 1 << 16 else "uint32", bins
    start = _binned(rows, label, cuts, shift, layout[1])
    path = scratch_path(spark, "boosting-blocks")
    dealt(start, sum(n for n, _ in about.values())).write.options(**LAYOUT).parquet(path)
    blocks = spark.read.schema(_BLOCK_DDL).parquet(path)
    try:
        return [_fitted(gbt, blocks, cuts, shift, layout, early_stop, track_history and not i) for i, gbt in enumerate(boosters)]
    finally:
        discard(spark, path)


def _fitted(
    gbt: GBTRegressor, state: DataFrame, cuts: list[list[float]], shift: float, layout: tuple[int, str, int], early_stop: bool, track_history: bool
) -> tuple[GBTRegressionModel, list[dict]]:
    """(model, history) of one booster over blocks."""
    spark, (features, dtype, bins) = state.sparkSession, layout
    share, seed, depth, rate = gbt.getSubsamplingRate(), gbt.getSeed(), gbt.getMaxDepth(), gbt.getStepSize()

    def step(leaves: Sequence[int], tree: int) -> _Next:
        return _Next(leaves, features, bins, share, seed, tree)

    java, weights, history, best, path, root = [], [], [], (np.inf, 0), None, None
    try:
        for n in range(gbt.getMaxIter()):
            sampled = lambda block, size, n=n: _sampled(share, seed, n, block, size)
            summed = lambda tree, nodes, state=state, sampled=sampled: _histograms(state, tree, nodes, features, dtype, bins, sampled)
            if root is None:
                root = summed(Grown(), [0])[0]
            tree = _grown(root, summed, depth, features, bins)
            # The first tree is fitted to the label with weight 1, further ones to twice the residual.
            factor, weight = (2.0, rate) if n else (1.0, 1.0)
            last = n + 1 == gbt.getMaxIter()
            leaves = tree.leaves
            taken = {k: factor * weight * tree.value(k) for k in leaves}

            def further(batches, tree=tree, taken=taken, sampled=sampled, last=last, made=lambda n=n, leaves=leaves: step(leaves, n + 1)):
                sums = made()
                for batch in batches:
                    for block, held, codes, residual in _blocks(batch, features, dtype):
                        new = residual.copy()
                        every = tree.routed(codes, np.arange(len(residual)), set(taken))
                        seen = np.zeros(len(residual))
                        if not held:
                            rows = sampled(block, len(residual))
                            seen[rows] = residual[rows] ** 2
                        for i, k in enumerate(sums.leaves):
                            new[every[k]] -= taken[k]
                            sums.sums[4 + i] += seen.take(every[k]).sum()
                        sums.root(block, held, codes, new)
                        if not last:
                            yield _row(block, held, codes.tobytes(), new.tobytes())
                yield _row(sums=sums.sums)

            grown = state.filter("block is not null").mapInArrow(further, _BLOCK_DDL)
            if not last:
                new_path = scratch_path(spark, "boosting-blocks")
                grown.write.options(**LAYOUT).parquet(new_path)
                if path:
                    discard(spark, path)
                state, path = spark.read.schema(_BLOCK_DDL).parquet(new_path), new_path
                grown = state.filter("sums is not null")
            (loss, held_loss), squares, root = step(leaves, n + 1).read(_total(grown.select("sums")))
            for k, square in zip(leaves, squares, strict=True):
                tree.stats[k][2] = square
            java.append(_java_tree(spark, tree, cuts, factor, 0.0 if n else shift, gbt.uid))
            weights.append(weight)
            history.append({"iteration": n + 1, "loss": loss, "eval_loss": held_loss})
            if early_stop:
                if n and best[0] - held_loss < gbt.getValidationTol() * max(held_loss, 0.01):
                    break
                if held_loss < best[0]:
                    best = held_loss, n + 1
    finally:
        if path:
            discard(spark, path)
    kept = best[1] if early_stop else len(java)
    array, ml = spark.sparkContext._gateway.new_array, spark._jvm.org.apache.spark.ml.regression
    trees, rates = array(ml.DecisionTreeRegressionModel, kept), array(spark._jvm.double, kept)
    for i in range(kept):
        trees[i], rates[i] = java[i], float(weights[i])
    model = gbt._copyValues(gbt._create_model(ml.GBTRegressionModel(gbt.uid, trees, rates, features)))
    model._transfer_params_to_java()
    return model, history[:kept] if track_history else []
