"""Nearest neighbours: exact, and approximate over the leaves of a clustering."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, partitions_for, scratch_path, store
from .cells import CELL_ROWS, Cells, build_cells, first_cells, further_cells, matrix_of, with_cells
from .ordered import top_k_per_group
from .quantiser import Quantiser, fit_quantiser

BLOCK_ROWS = 20_000
LEAF_SALTS = 16
# An index is calibrated with so many of its rows to find this share of their neighbours, and the candidates, in times
# the rows asked for, that may be measured exactly.
CALIBRATION_ROWS, RECALL, CANDIDATE_FACTORS = 300, 0.95, (2, 4, 8, 16, 32, 64)
METRICS = ("l2", "dot", "cosine")


def _scores(base: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Matrix (query, base) of costs: smaller is nearer for every metric."""
    product = queries @ base.T
    if metric == "dot":
        return -product
    if metric == "cosine":
        lengths = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(base, axis=1)[None, :]
        return -np.divide(product, lengths, out=np.zeros_like(product), where=lengths > 0)
    squares = (queries**2).sum(axis=1)[:, None] + (base**2).sum(axis=1)[None, :] - 2 * product
    return np.sqrt(np.maximum(squares, 0.0))


def _nearest(rows: pd.DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, metric: str) -> pd.DataFrame:
    """The k nearest of ``rows`` for each query as (query, id, crowd, cost).

    Costs from the matrix product choose candidates with a small margin; differences give their final cost.
    """
    base = matrix_of(rows["_vec"])
    step = max(1, 4_000_000 // len(base))
    parts = []
    for start in range(0, len(queries), step):
        block = queries[start : start + step]
        costs = _scores(base, block, metric)
        if len(base) > k:
            limit = np.partition(costs, k - 1, axis=1)[:, k - 1]
            q, b = np.nonzero(costs <= (limit + 1e-7 * (1 + np.abs(limit)))[:, None])
        else:
            q, b = np.nonzero(np.ones_like(costs, dtype=bool))
        cost = np.sqrt(((base[b] - block[q]) ** 2).sum(axis=1)) if metric == "l2" else costs[q, b]
        parts.append(pd.DataFrame({"query": ids[start + q], "id": rows["_id"].to_numpy()[b],
                                   "crowd": rows["_crowd"].to_numpy()[b], "cost": cost}))
    return _keep(pd.concat(parts), k, None)


def _keep(found: pd.DataFrame, k: int, crowding: int | None) -> pd.DataFrame:
    # Texts as plain objects: pandas may hold them in chunks, which no Arrow struct takes.
    found = found.assign(cost=found["cost"].round(12), crowd=found["crowd"].astype(object)).sort_values(["query", "cost", "id"])
    if crowding is not None:
        found = found[found.groupby(["query", "crowd"], dropna=False).cumcount() < crowding]
    return found[found.groupby("query").cumcount() < k]


def _search(rows: pd.DataFrame, ids, queries, k, metric, crowding) -> pd.DataFrame:
    """One block of each side; per crowd value when there is a crowding limit."""
    groups = [rows] if crowding is None else [g for _, g in rows.groupby("_crowd", dropna=False)]
    return _keep(pd.concat([_nearest(g, ids, queries, min(k, crowding or k), metric) for g in groups]), k, crowding)


def _rank(found: DataFrame, k: int, metric: str, crowding: int | None) -> DataFrame:
    """The partial winners of all tasks merged into (query, id, score, rank)."""
    if crowding is not None:
        found = top_k_per_group(found, ["query", "crowd"], ["cost", "id"], crowding)
    best = top_k_per_group(found, "query", ["cost", "id"], k, rank="rank")
    score = F.col("cost") if metric == "l2" else -F.col("cost")
    return best.select("query", "id", score.alias("score"), "rank")


def knn_exact(
    base: DataFrame, queries: DataFrame, k: int, metric: str = "l2", id_col: str = "vec_id",
    vec_col: str = "embedding", where: Column | str | None = None, crowd_col: str | None = None,
    crowding: int | None = None, query_id: str | None = None, query_vec: str | None = None, cells: int | None = None,
) -> DataFrame:
    """(query, id, score, rank): the k nearest base rows of each query vector, ties by id.

    ``where`` filters base rows; with ``crowding`` at most that many neighbours share a ``crowd_col`` value. Base rows
    belong to the cell of their nearest pivot. A query is first measured against the nearest cells that hold k rows,
    which bounds how far its neighbours are, then against those cells alone that can hold one within the bound.
    Queries and cells meet in tasks of bounded size; neither side goes through the driver. ``cells`` is their number,
    by default one for every 20,000 rows, 1024 at most: the result does not depend on it.
    """
    return _rank(_meetings(base, queries, k, metric, id_col, vec_col, where, crowd_col, crowding, query_id, query_vec, cells)[0], k, metric, crowding)


def rows_met(base: DataFrame, queries: DataFrame, k: int, metric: str = "l2", id_col: str = "vec_id", vec_col: str = "embedding",
             query_id: str | None = None, query_vec: str | None = None, cells: int | None = None) -> DataFrame:
    """(query, cells, rows): how many cells and base rows ``knn_exact`` measures each query against."""
    _, pairs, built = _meetings(base, queries, k, metric, id_col, vec_col, None, None, None, query_id, query_vec, cells)
    sizes = F.array(*[F.lit(int(n)) for n in built.sizes])
    return pairs.groupBy(F.col("_query").alias("query")).agg(
        F.count(F.lit(1)).alias("cells"), F.sum(F.get(sizes, F.col("_cell"))).cast("bigint").alias("rows")
    )


def _meetings(base, queries, k, metric, id_col, vec_col, where, crowd_col, crowding, query_id, query_vec, cells):
    """The winners of every meeting of a query with a cell, the pairs that met, and the cells."""
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}")
    spark = base.sparkSession
    rows = _base_rows(base, id_col, vec_col, where, crowd_col, crowding)
    asked, shape = _asked(queries, query_id or id_col, query_vec or vec_col)
    n = rows.count()
    if not n or not shape["n"]:
        return spark.createDataFrame([], _found_schema(rows, asked)), asked.withColumn("_cell", F.lit(0)), None
    if (cells or -(-n // CELL_ROWS)) == 1:
        # One cell: every query meets it whole.
        everywhere = asked.withColumn("_cell", F.lit(0))
        found = _search_blocks(rows, asked, k, metric, crowding, shape["n"], n)
        return found, everywhere, Cells(metric, 0.0, np.zeros((1, 1)), np.array([n]), np.zeros(1))
    rows = store(rows, "cell-rows")
    built = build_cells(rows, n, metric, cells)
    placed = store(with_cells(rows, built).drop("_reach"), "cells")
    largest = int(built.sizes.max())
    began = store(first_cells(asked, built, k), "cells-asked")
    first = store(_search_blocks(placed, began, k, metric, crowding, shape["n"], largest, ["_cell"]), "cells-found")
    last = _rank(first, k, metric, crowding).filter(F.col("rank") == k).select(
        F.col("query").alias("_query"), (F.col("score") if metric == "l2" else -F.col("score")).alias("_bound")
    )
    seen = began.groupBy("_query").agg(F.collect_set("_cell").alias("_seen"))
    bounded = asked.join(seen, "_query").join(last, "_query", "left")
    more = store(further_cells(bounded, built).select("_query", "_vec", "_cell"), "cells-asked")
    second = _search_blocks(placed, more, k, metric, crowding, shape["n"], largest, ["_cell"])
    return first.unionByName(second), began.unionByName(more), built


def _asked(queries: DataFrame, id_col: str, vec_col: str):
    """The query vectors, stored once, with their number and length."""
    asked = cut_lineage(
        queries.select(F.col(id_col).alias("_query"), F.col(vec_col).cast("array<double>").alias("_vec"))
        .filter(F.col("_vec").isNotNull())
    )
    return asked, asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_vec")).alias("dim")).first()


def _base_rows(base, id_col, vec_col, where, crowd_col, crowding) -> DataFrame:
    if (crowding is None) != (crowd_col is None):
        raise ValueError("crowding and crowd_col go together")
    if where is not None:
        base = base.filter(where)
    crowd = F.col(crowd_col).cast("string") if crowd_col else F.lit(None).cast("string")
    return base.select(
        F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_vec"), crowd.alias("_crowd")
    ).filter(F.col("_vec").isNotNull())


def _found_schema(rows: DataFrame, asked: DataFrame) -> str:
    kinds = dict(rows.dtypes) | dict(asked.dtypes)
    return f"query {kinds['_query']}, id {kinds['_id']}, crowd string, cost double"


def _blocks(rows: DataFrame, asked: DataFrame, n: int, base_rows: int, by: Sequence[str], meet, schema: str) -> DataFrame:
    """Base and queries in hash blocks of bounded size; blocks of the same ``by`` meet in a task of their own."""
    query_blocks, base_blocks = math.ceil(max(n, 1) / BLOCK_ROWS), math.ceil(max(base_rows, 1) / BLOCK_ROWS)
    block = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = rows.withColumn("_b", block("_id", base_blocks)).withColumn("_q", every(query_blocks))
    right = asked.withColumn("_q", block("_query", query_blocks)).withColumn("_b", every(base_blocks))
    keys = [*by, "_b", "_q"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, schema)


def _search_blocks(
    rows: DataFrame, asked: DataFrame, k: int, metric: str, crowding: int | None, n: int, base_rows: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """The winners of every block of queries in every block of the base."""

    def search(base: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if base.empty or queries.empty:
            return pd.DataFrame({"query": [], "id": [], "crowd": [], "cost": []}, dtype=object)
        return _search(base, queries["_query"].to_numpy(), matrix_of(queries["_vec"]), k, metric, crowding)

    return _blocks(rows, asked, n, base_rows, by, search, _found_schema(rows, asked))


def knn_join(
    base: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
    metric: str = "l2", full_row: bool = False, query_id: str | None = None, query_vec: str | None = None,
) -> DataFrame:
    """``knn_exact`` with the option of the whole base row for every neighbour."""
    found = knn_exact(base, queries, k, metric, id_col, vec_col, query_id=query_id, query_vec=query_vec)
    found = found.withColumnRenamed("id", id_col)
    return base.join(found, id_col) if full_row else found


def build_index(
    base: DataFrame, path: str, leaves: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 1,
    recall: float = RECALL,
) -> None:
    """Stores the vectors below ``path`` in one folder per k-means leaf: beside each its residual code, a byte for every
    few coordinates; the leaf centres and sizes, the codebooks, and how much a search has to look at.

    Without ``leaves`` there are as many as the square root of the rows. A leaf is written by several tasks, so a
    crowded one is neither a single task nor a single file. How many leaves a search probes and how many candidates it
    measures exactly are calibrated here: the least with which a sample of the rows finds ``recall`` of its 10 nearest.
    """
    spark = base.sparkSession
    rows = _base_rows(base, id_col, vec_col, None, None, None).drop("_crowd")
    rows = store(rows, "index-rows").withColumn("_features", array_to_vector("_vec"))  # k-means reads them many times
    n = rows.count()
    if leaves is None:
        leaves = max(1, math.isqrt(n))
    model = KMeans(k=leaves, seed=seed, featuresCol="_features", predictionCol="_leaf", maxIter=10).fit(rows)
    centres = np.array(model.clusterCenters())
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("array<double>")
    def residual(leaf: pd.Series, vectors: pd.Series) -> pd.Series:
        return pd.Series(list(matrix_of(vectors) - shared.value[leaf.to_numpy()])) if len(leaf) else pd.Series([], dtype=object)

    leafed = store(model.transform(rows).drop("_features"), "index-leaves")
    quantiser = fit_quantiser(leafed.select("_id", residual("_leaf", "_vec").alias("_residual")), centres.shape[1], seed)
    books = spark.sparkContext.broadcast(quantiser)

    @F.pandas_udf("binary")
    def code(leaf: pd.Series, vectors: pd.Series) -> pd.Series:
        if not len(leaf):
            return pd.Series([], dtype=object)
        return pd.Series([c.tobytes() for c in books.value.codes(matrix_of(vectors) - shared.value[leaf.to_numpy()])])

    salt = F.pmod(F.xxhash64("_id"), F.lit(LEAF_SALTS))
    coded = leafed.withColumn("_code", code("_leaf", "_vec")).repartition(partitions_for(rows), "_leaf", salt)
    coded.write.mode("overwrite").partitionBy("_leaf").parquet(f"{path}/rows")
    sizes = {r["_leaf"]: r["count"] for r in spark.read.parquet(f"{path}/rows").groupBy("_leaf").count().collect()}  # one per leaf
    kept = [(i, [float(x) for x in c], sizes.get(i, 0)) for i, c in enumerate(centres)]
    spark.createDataFrame(kept, "leaf int, centre array<double>, size long").write.mode("overwrite").parquet(f"{path}/centres")
    kept = [(i, int(b.shape[1]), [float(x) for x in b.ravel()]) for i, b in enumerate(quantiser.books)]
    spark.createDataFrame(kept, "piece int, width int, book array<double>").write.mode("overwrite").parquet(f"{path}/codebooks")
    probes, candidates = _calibrated(spark, path, rows.select("_id", "_vec"), n, recall)
    made = spark.createDataFrame([(probes, candidates, recall)], "probes int, candidates int, recall double")
    made.write.mode("overwrite").parquet(f"{path}/calibration")


@dataclass
class _Index:
    """What every task of a search needs to know of an index."""

    centres: np.ndarray
    sizes: np.ndarray
    quantiser: Quantiser

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> _Index:
        stored = spark.read.parquet(f"{path}/centres").orderBy("leaf").collect()  # one row per leaf
        books = spark.read.parquet(f"{path}/codebooks").orderBy("piece").collect()  # one row per few coordinates
        return cls(
            np.array([r["centre"] for r in stored]), np.array([r["size"] for r in stored]),
            Quantiser([np.array(r["book"]).reshape(-1, r["width"]) for r in books]),
        )

    def probed(self, queries: np.ndarray, probes: int, k: int) -> list[np.ndarray]:
        """The ``probes`` nearest leaves of each query, or as many more as hold ``k`` rows between them, nearest first."""
        near = np.argsort(_scores(self.centres, queries, "l2"), axis=1)
        before = np.cumsum(self.sizes[near], axis=1) - self.sizes[near]
        mask = (np.arange(near.shape[1]) < probes) | (before < k)
        return [n[m].astype("int32") for n, m in zip(near, mask, strict=True)]


def _calibrated(spark: SparkSession, path: str, rows: DataFrame, n: int, recall: float) -> tuple[int, int]:
    """(probes, candidates) by about ``CALIBRATION_ROWS`` of the rows and their exact neighbours."""
    k = min(10, n)
    if not k:
        return 1, 1
    asked = store(rows.filter(F.pmod(F.xxhash64(F.lit("calibration"), "_id"), F.lit(1_000_000)) < 1_000_000 * min(1.0, CALIBRATION_ROWS / n)), "calibration")
    if asked.isEmpty():
        asked = store(rows.limit(1), "calibration")
    true = knn_exact(rows, asked, k, id_col="_id", vec_col="_vec").select(F.col("query").alias("_query"), F.col("id").alias("_id"))
    index = _Index.load(spark, path)
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf("array<int>")
    def order(vectors: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probed(matrix_of(vectors), len(shared.value.centres), 1)) if len(vectors) else pd.Series([], dtype=object)

    asked = asked.select(F.col("_id").alias("_query"), "_vec")
    true = store(true.join(spark.read.parquet(f"{path}/rows").select("_id", "_leaf"), "_id").join(asked.withColumn("_order", order("_vec")), "_query")
                 .select("_query", "_id", F.array_position("_order", F.col("_leaf")).alias("place")), "calibration-true")
    ranks = true.groupBy("place").count().orderBy("place").collect()  # at most one row per leaf
    # Half of what may be missed is left to the codes.
    total, found, probes = sum(r["count"] for r in ranks), 0, len(index.centres)
    for r in ranks:
        found += r["count"]
        if found >= (1 + recall) / 2 * total:
            probes = int(r["place"])
            break
    most = CANDIDATE_FACTORS[-1] * k
    coarse = _candidates(spark, path, index, asked, probes, k, most)
    places = true.join(coarse.select(F.col("query").alias("_query"), F.col("id").alias("_id"), "rank"), ["_query", "_id"])
    hits = places.agg(*[F.count(F.when(F.col("rank") <= f * k, 1)).alias(f"f{f}") for f in CANDIDATE_FACTORS]).first()
    factor = next((f for f in CANDIDATE_FACTORS if hits[f"f{f}"] >= recall * total), CANDIDATE_FACTORS[-1])
    return probes, factor


def _candidates(spark: SparkSession, path: str, index: _Index, asked: DataFrame, probes: int, k: int, most: int) -> DataFrame:
    """(query, id, crowd, cost, leaf, rank): the ``most`` rows of the probed leaves that are nearest by their codes.

    Queries and the codes of a leaf meet in tasks of bounded size; vectors are not read.
    """
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf("array<int>")
    def leaves_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probed(matrix_of(vectors), probes, k)) if len(vectors) else pd.Series([], dtype=object)

    spread = store(asked.withColumn("_leaf", F.explode(leaves_of("_vec"))), "index-asked")
    wanted = [r["_leaf"] for r in spread.select("_leaf").distinct().collect()]  # at most one row per leaf
    rows = spark.read.parquet(f"{path}/rows").select("_id", "_code", "_leaf").filter(F.col("_leaf").isin(wanted))
    kinds = dict(rows.dtypes) | dict(asked.dtypes)

    def near(codes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(codes) and len(queries):
            index, leaf = shared.value, int(codes["_leaf"].iloc[0])
            matrix = np.frombuffer(b"".join(codes["_code"]), np.uint8).reshape(len(codes), -1)
            ids = codes["_id"].to_numpy()
            for query, vector in zip(queries["_query"], queries["_vec"], strict=True):
                cost = index.quantiser.distances(matrix, np.asarray(vector, "float64") - index.centres[leaf])
                keep = np.argpartition(cost, most - 1)[:most] if len(cost) > most else np.arange(len(cost))
                parts.append(pd.DataFrame({"query": query, "id": ids[keep], "leaf": leaf, "cost": cost[keep]}))
        return pd.concat(parts) if parts else pd.DataFrame({"query": [], "id": [], "leaf": [], "cost": []}, dtype=object)

    largest = int(index.sizes.max())
    found = _blocks(rows, spread, asked.count(), largest, ["_leaf"], near, f"query {kinds['_query']}, id {kinds['_id']}, leaf int, cost double")
    return top_k_per_group(found, "query", ["cost", "id"], most, rank="rank")


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int, probes: int | None = None, query_id: str = "vec_id",
    query_vec: str = "embedding", candidates: int | None = None,
) -> DataFrame:
    """(query, id, score, rank) by L2 distance among the ``probes`` leaves nearest to each query, or as many more as
    hold k rows between them. By default the index's own calibrated number.

    The rows of these leaves are compared by their codes alone, and the ``candidates`` times k nearest by those are
    measured exactly; given ``probes`` and no ``candidates``, all are.
    """
    asked, shape = _asked(queries, query_id, query_vec)
    rows = spark.read.parquet(f"{path}/rows")
    calibration, index = spark.read.parquet(f"{path}/calibration").first(), _Index.load(spark, path)
    if not shape["n"] or not index.sizes.sum():
        return _rank(spark.createDataFrame([], _found_schema(rows, asked)), k, "l2", None)
    if candidates is None:
        candidates = calibration["candidates"] if probes is None else None
    probes = calibration["probes"] if probes is None else probes
    most = int(index.sizes.sum()) if candidates is None else max(k, candidates * k)
    coarse = store(_candidates(spark, path, index, asked, probes, k, most), "index-candidates")
    read = [r["leaf"] for r in coarse.select("leaf").distinct().collect()]  # at most one row per leaf
    vectors = rows.select("_id", F.col("_leaf").alias("leaf"), F.col("_vec").alias("_base")).filter(F.col("_leaf").isin(read))
    pairs = coarse.alias("c").join(vectors.alias("v"), (F.col("c.id") == F.col("v._id")) & (F.col("c.leaf") == F.col("v.leaf")))
    pairs = pairs.select("c.query", "c.id", "v._base").join(asked.withColumnRenamed("_query", "query"), "query")
    gap = F.aggregate(F.zip_with("_base", "_vec", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)
    found = pairs.select("query", "id", F.lit(None).cast("string").alias("crowd"), F.round(F.sqrt(gap), 12).alias("cost"))
    return _rank(found, k, "l2", None)


def index_share(spark: SparkSession, path: str) -> float:
    """The share of an index's rows that a query is compared with by default, were all leaves of one size."""
    calibration, leaves = spark.read.parquet(f"{path}/calibration").first(), spark.read.parquet(f"{path}/centres").count()
    return calibration["probes"] / leaves


def knn_approx(
    base: DataFrame, queries: DataFrame, k: int, leaves: int | None = None, probes: int | None = None, id_col: str = "vec_id",
    vec_col: str = "embedding", query_id: str | None = None, query_vec: str | None = None, seed: int = 1,
) -> DataFrame:
    """An index built for this one search; keep one with ``build_index`` to search it again."""
    path = scratch_path(base.sparkSession, "leaves")
    build_index(base, path, leaves, id_col, vec_col, seed)
    return search_index(base.sparkSession, path, queries, k, probes, query_id or id_col, query_vec or vec_col)
