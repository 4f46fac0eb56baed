"""Residual product quantisation: a vector less its leaf's centre, in pieces of a few coordinates, each a byte.

The codebook of a piece is fitted in a task of its own, on a bounded sample of the residuals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Residuals the codebooks are fitted on, coordinates of a piece, and values of a byte.
SAMPLE_ROWS, PIECE, VALUES = 20_000, 4, 256


def kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of points in few dimensions."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    if len(distinct) <= k:
        return centres
    for _ in range(rounds):
        near = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]).argmin(1)
        counts = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, points[:, i], k) for i in range(points.shape[1])], 1)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


@dataclass
class Quantiser:
    """One codebook (values, coordinates) per piece."""

    books: list[np.ndarray]

    def pieces(self, residuals: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([b.shape[1] for b in self.books])
        return np.split(residuals, ends[:-1], axis=1)

    def codes(self, residuals: np.ndarray) -> np.ndarray:
        """Bytes (rows, pieces): the nearest value of every piece."""
        found = []
        for part, book in zip(self.pieces(residuals), self.books, strict=True):
            found.append(((book**2).sum(1)[None, :] - 2 * part @ book.T).argmin(1))
        return np.stack(found, 1).astype(np.uint8)

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """(pieces, values): the squared distance of a query's residual to every value."""
        out = np.full((len(self.books), VALUES), np.inf)
        for i, (part, book) in enumerate(zip(self.pieces(residual[None, :]), self.books, strict=True)):
            out[i, : len(book)] = ((book - part) ** 2).sum(1)
        return out

    def distances(self, codes: np.ndarray, residual: np.ndarray) -> np.ndarray:
        """About the squared distance of a query to the rows of a leaf."""
        return self.tables(residual)[np.arange(len(self.books))[None, :], codes].sum(1)


def fit_quantiser(residuals: DataFrame, dim: int, seed: int = 1, sample_rows: int = SAMPLE_ROWS, piece: int = PIECE) -> Quantiser:
    """Codebooks from stored rows (_id, _residual); the sample is chosen by a hash of the id."""
    rows = residuals.count()
    sample = residuals if rows <= sample_rows else residuals.filter(
        F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1_000_000)) < 1_000_000 * sample_rows / rows
    )
    starts = list(range(0, dim, piece))
    cut = F.array(*[F.struct(F.lit(i).alias("piece"), F.slice("_residual", s + 1, piece).alias("part")) for i, s in enumerate(starts)])

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        centres = kmeans(np.stack(part["part"].to_numpy()).astype("float64"), VALUES, seed + int(key[0]))
        return pd.DataFrame({"piece": [int(key[0])], "book": [centres.ravel()]})

    books = sample.select(F.inline(cut)).groupBy("piece").applyInPandas(fit, "piece int, book array<double>")
    found = {r["piece"]: np.array(r["book"]) for r in books.collect()}  # dim / piece rows of 256 values
    return Quantiser([found[i].reshape(-1, min(piece, dim - s)) for i, s in enumerate(starts)])
