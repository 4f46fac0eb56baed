"""Pivot cells: every vector belongs to its nearest pivot, and the triangle inequality says which cells a query needs.

All three metrics become distances of changed vectors with the same order: cosine by unit vectors (one without length
stands at a right angle to all others), the dot product by one more coordinate that fills every base vector up to the
longest one's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pivots at most (they are sent to every task) and base rows that are worth one.
MOST_CELLS, CELL_ROWS = 1024, 20_000


def matrix_of(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in vectors])


def as_distance(vectors: np.ndarray, metric: str, longest: float = 0.0, query: bool = False) -> np.ndarray:
    """Vectors whose distances have the order of the metric's costs."""
    if metric == "l2":
        return vectors
    lengths = np.linalg.norm(vectors, axis=1)
    if metric == "cosine":
        bare = lengths == 0
        unit = np.divide(vectors, lengths[:, None], out=np.zeros_like(vectors), where=~bare[:, None])
        # A query and a base row without length have axes of their own: their product with anything is 0.
        return np.column_stack([unit, bare & (not query), bare & query])
    filled = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(longest**2 - lengths**2, 0.0))
    return np.column_stack([vectors, filled])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix of distances (a, b)."""
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))


@dataclass
class Cells:
    """Pivots in distance form, and of every cell its number of rows and the largest distance to its pivot."""

    metric: str
    longest: float
    pivots: np.ndarray
    sizes: np.ndarray
    radii: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of base vectors and the distance to its pivot."""
        d = distances(as_distance(vectors, self.metric, self.longest), self.pivots)
        at = d.argmin(1)
        return at, d[np.arange(len(d)), at]

    def slack(self, d: np.ndarray) -> np.ndarray:
        """What rounding may add to a distance: products of long vectors lose half their digits."""
        return 1e-6 * (1.0 + d + np.abs(self.pivots).max(initial=0.0))

    def first(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """The nearest cells of each query that hold ``k`` rows between them."""
        d = distances(as_distance(queries, self.metric, query=True), self.pivots)
        near = np.argsort(np.where(self.sizes > 0, d, np.inf), axis=1)
        before = np.cumsum(self.sizes[near], axis=1) - self.sizes[near]
        return [n[(b < k) & (self.sizes[n] > 0)].astype("int32") for n, b in zip(near, before, strict=True)]

    def allowed(self, queries: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """The cells that may hold a row at a query's bound or nearer.

        A row of a cell is no nearer than the pivot less the cell's radius, and no nearer than half way, along the line
        between the query's nearest pivot and its own, as it would be of the other cell then.
        """
        q = as_distance(queries, self.metric, query=True)
        d = distances(q, self.pivots)
        between = distances(self.pivots, self.pivots)
        own = d.argmin(1)
        line = between[own]
        half = np.divide(d**2 - (d[np.arange(len(d)), own] ** 2)[:, None], 2 * line, out=np.zeros_like(d), where=line > 0)
        least = np.maximum(d - self.radii[None, :], half) - self.slack(d)
        return [np.flatnonzero(m & (self.sizes > 0)).astype("int32") for m in least <= bounds[:, None]]

    def bound(self, costs: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Distances of a metric's costs."""
        if self.metric == "l2":
            return costs
        if self.metric == "cosine":
            return np.sqrt(np.maximum(2.0 + 2.0 * costs, 0.0))
        return np.sqrt(np.maximum((queries**2).sum(1) + self.longest**2 + 2.0 * costs, 0.0))


def build_cells(rows: DataFrame, n: int, metric: str, cells: int | None = None) -> Cells:
    """Cells over stored rows (_id, _vec): pivots are rows chosen by a hash of their id, one pass for the statistics."""
    wanted = min(MOST_CELLS, n, cells or -(-n // CELL_ROWS))
    chosen = rows.orderBy(F.xxhash64("_id"), "_id").limit(wanted).select("_vec")
    pivots = matrix_of(pd.Series([r["_vec"] for r in chosen.collect()]))
    squares = F.aggregate("_vec", F.lit(0.0), lambda a, x: a + x * x)
    longest = float(np.sqrt(rows.agg(F.max(squares)).first()[0])) if metric == "dot" else 0.0
    found = Cells(metric, longest, as_distance(pivots, metric, longest), np.zeros(len(pivots)), np.zeros(len(pivots)))
    # Equal pivots would leave empty cells.
    found.pivots = np.unique(found.pivots, axis=0)
    stats = with_cells(rows.select("_id", "_vec"), found).groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_reach").alias("r"))
    found.sizes, found.radii = np.zeros(len(found.pivots), np.int64), np.zeros(len(found.pivots))
    for r in stats.collect():  # one row per cell
        found.sizes[r["_cell"]], found.radii[r["_cell"]] = r["n"], r["r"]
    return found


def with_cells(rows: DataFrame, cells: Cells) -> DataFrame:
    """The rows with ``_cell`` and ``_reach``, the distance to its pivot."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    @F.pandas_udf("cell int, reach double")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            at, reach = shared.value.nearest(matrix_of(vectors)) if len(vectors) else (np.empty(0, int), np.empty(0))
            yield pd.DataFrame({"cell": at.astype("int32"), "reach": reach})

    placed = rows.withColumn("_place", place("_vec"))
    return placed.select("*", F.col("_place.cell").alias("_cell"), F.col("_place.reach").alias("_reach")).drop("_place")


def first_cells(asked: DataFrame, cells: Cells, k: int) -> DataFrame:
    """One row per query and cell it begins with."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)

    @F.pandas_udf("array<int>")
    def chosen(vectors: pd.Series) -> pd.Series:
        return pd.Series(shared.value.first(matrix_of(vectors), k)) if len(vectors) else pd.Series([], dtype=object)

    return asked.withColumn("_cell", F.explode(chosen("_vec")))


def further_cells(asked: DataFrame, cells: Cells) -> DataFrame:
    """One row per query and further cell it needs: asked has ``_bound``, the cost of its k-th row so far or NULL,
    and ``_seen``, the cells it began with."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)

    @F.pandas_udf("array<int>")
    def chosen(vectors: pd.Series, costs: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        queries = matrix_of(vectors)
        bound = np.where(costs.isna(), np.inf, shared.value.bound(costs.fillna(0).to_numpy("float64"), queries))
        return pd.Series(shared.value.allowed(queries, bound))

    return asked.withColumn("_cell", F.explode(F.array_except(chosen("_vec", "_bound"), "_seen")))
