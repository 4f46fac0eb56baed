"""Packing documents into token windows by non-negative least squares.

Each document is cut into full windows and a rest. The histogram of rests (at most one count per length
below the window) goes to the driver, which enumerates shallow combinations of lengths that fill a window,
solves their repeat counts against the histogram by non-negative least squares, rounds them, and packs what
is left greedily. Rests whose greedy window stays open are cut at powers of two and packed the same way, so
that only the last sequence can hold padding. The plan is a table from (length, rank) to (sequence, offset);
ranks come from counts per task and length, so no length, however common, meets in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store
from .common import arrow_schema
from .tokens import encoder

#: Ranks of one length stay below this.
RANKS = 1 << 44


def binary_parts(length: int) -> list[int]:
    """The powers of two that sum to ``length``, largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def combinations(counts: np.ndarray, window: int, spread: int = 8, heavy: int = 16) -> np.ndarray:
    """Pairs and triples of present lengths that fill a window exactly, as rows padded with 0.

    All pairs; for each smallest length of a triple ``spread`` evenly spaced middle lengths; and every triple
    that holds one of the ``heavy`` commonest lengths.
    """
    present = np.flatnonzero(counts[:window])
    here = np.zeros(window + 1, bool)
    here[present] = True
    found = {(int(a), window - int(a), 0) for a in present if 2 * a <= window and here[window - a]}
    for a in present[3 * present <= window]:
        middle = present[(present >= a) & (2 * present <= window - a)]
        middle = middle[here[window - a - middle]]
        picks = middle[np.unique(np.linspace(0, len(middle) - 1, min(spread, len(middle))).astype(int))] if len(middle) else middle
        found.update((int(a), int(b), int(window - a - b)) for b in picks)
    for a in present[np.argsort(-counts[present], kind="stable")[:heavy]]:
        others = present[(present <= window - a - 1) & (2 * present <= window - a)]
        others = others[here[window - a - others]]
        found.update(tuple(sorted((int(a), int(b), int(window - a - b)))) for b in others)
    found = {tuple(sorted(x, reverse=True)) for x in found}
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def solve_counts(combos: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|, A counting each length in each combination.

    Accelerated projected gradient with one step size per combination; A is only ever used by its entries.
    """
    size = len(counts)
    real = (combos > 0).astype(float)
    x = y = np.zeros(len(combos))
    if not len(combos):
        return x
    times = lambda v: np.bincount(combos.ravel(), (real * v[:, None]).ravel(), size)
    degree = np.bincount(combos.ravel(), (real * real.sum(1, keepdims=True)).ravel(), size)
    bound = (degree[combos] * real).sum(1)
    target, t = counts.astype(float), 1.0
    for _ in range(steps):
        wrong = times(y) - target
        new = np.maximum(0, y - (wrong[combos] * real).sum(1) / bound)
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def greedy_patterns(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Windows packed largest first with the largest rest that still fits, as (lengths, repeats). Empties ``left``."""
    found = []
    present = [int(x) for x in np.flatnonzero(left)]
    while present:
        gap, pattern, at = window, [], len(present) - 1
        use: Counter = Counter()
        while gap and at >= 0:
            at = int(np.searchsorted(present, gap, "right")) - 1
            while at >= 0 and use[present[at]] >= left[present[at]]:
                at -= 1
            if at >= 0:
                pattern.append(present[at])
                use[present[at]] += 1
                gap -= present[at]
        repeats = min(int(left[k]) // n for k, n in use.items())
        for k, n in use.items():
            left[k] -= repeats * n
        found.append((tuple(pattern), repeats))
        present = [k for k in present if left[k]]
    return found


def plan_windows(counts: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: rows (length * RANKS + first rank, sequence or -1, offset, ...), sorted.

    A sequence of -1 says that the piece is cut at powers of two; the further columns are the first rank of each bit's
    part, which ``parts`` places in the same way.
    """
    left = counts.copy()
    whole = int(left[window])
    left[window] = 0
    combos = combinations(left, window)
    x = solve_counts(combos, left)
    patterns: list[tuple[tuple[int, ...], int]] = [((window,), whole)] if whole else []
    for i in np.argsort(-x, kind="stable"):
        lengths = tuple(int(k) for k in combos[i] if k)
        repeats = min(int(round(x[i])), *(int(left[k]) // n for k, n in Counter(lengths).items()))
        if repeats > 0:
            for k in lengths:
                left[k] -= repeats
            patterns.append((lengths, repeats))
    opened: Counter = Counter()
    for lengths, repeats in greedy_patterns(left, window):
        if sum(lengths) == window or sum(lengths).bit_count() == 1:
            patterns.append((lengths, repeats))
        else:
            for k in lengths:
                opened[k] += repeats
    parts = np.zeros(window + 1, np.int64)
    for k, n in opened.items():
        for p in binary_parts(k):
            parts[p] += n
    rows, cut_rows, used, cut_used, sequence = [], [], Counter(), Counter(), 0

    bits = window.bit_length()

    def place(pattern, repeats, into, ranks):
        nonlocal sequence
        offset = 0
        for k in pattern:
            into.append((k * RANKS + ranks[k], sequence, offset) + (0,) * bits)
            ranks[k] += repeats
            offset += k
        sequence += repeats

    for lengths, repeats in patterns:
        place(lengths, repeats, rows, used)
    for lengths, repeats in greedy_patterns(parts.copy(), window):
        place(lengths, repeats, cut_rows, cut_used)
    taken: Counter = Counter()
    for k, n in opened.items():
        first = [0] * bits
        for p in binary_parts(k):
            first[p.bit_length() - 1] = taken[p]
            taken[p] += n
        rows.append((k * RANKS + used[k], -1, 0, *first))
    as_array = lambda r: np.array(sorted(r), np.int64).reshape(-1, 3 + bits)
    return {"pieces": as_array(rows), "parts": as_array(cut_rows)[:, :3]}


_PIECE, _PIECE_DDL = arrow_schema(
    doc_id="long", start="long", length="long", ids_crc32="long", doc_tokens="long", task="int", rank="long",
    part_crcs="array<long>", ids="binary",
)
_PLACED, _PLACED_DDL = arrow_schema(
    doc_id="long", start="long", length="long", ids_crc32="long", doc_tokens="long", sequence_id="long", offset="long",
    ids="binary",
)


def _cut(batches, path: str, window: int, end_id: int, with_ids: bool):
    task, ranks, tool = TaskContext.get().partitionId(), Counter(), encoder(path)
    for batch in batches:
        out: list[tuple] = []
        for doc_id, ids in zip(batch.column(0).to_pylist(), tool.documents(batch.column(1), end_id), strict=True):
            total = len(ids)
            for start in range(0, total, window):
                piece = ids[start : start + window]
                n = len(piece)
                crcs, at = [], 0
                for p in binary_parts(n) if n < window else ():
                    crcs.append(zlib.crc32(piece[at : at + p]))
                    at += p
                out.append((doc_id, start, n, zlib.crc32(piece), total, task, ranks[n], crcs, piece.tobytes() if with_ids else None))
                ranks[n] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(_PIECE), _PIECE, strict=True)], schema=_PIECE
        )


def _place(batches, plan: dict[str, np.ndarray]):
    pieces, parts = plan["pieces"], plan["parts"]
    for batch in batches:
        got = {n: batch.column(n) for n in batch.schema.names}
        number = lambda n: got[n].to_numpy(zero_copy_only=False)  # noqa: E731, B023
        length, rank = number("length"), number("rank") + number("before")
        key = length * RANKS + rank
        row = pieces[np.searchsorted(pieces[:, 0], key, "right") - 1] if len(batch) else pieces[:0]
        ahead = key - row[:, 0]
        sequence, offset = row[:, 1] + ahead, row[:, 2]
        stays = row[:, 1] >= 0
        keep = pa.array(stays)
        columns = [got[n].filter(keep) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        columns += [pa.array(sequence[stays]), pa.array(offset[stays]), got["ids"].filter(keep)]
        yield pa.RecordBatch.from_arrays(columns, schema=_PLACED)
        out = []
        for i in np.flatnonzero(~stays):
            values = {n: got[n][int(i)].as_py() for n in ("doc_id", "start", "doc_tokens", "part_crcs", "ids")}
            at = 0
            for p, crc in zip(binary_parts(int(length[i])), values["part_crcs"], strict=True):
                part_key = p * RANKS + int(row[i, 3 + p.bit_length() - 1]) + int(ahead[i])
                _, first, place = part = parts[np.searchsorted(parts[:, 0], part_key, "right") - 1]
                ids = values["ids"] and values["ids"][4 * at : 4 * (at + p)]
                out.append((values["doc_id"], values["start"] + at, p, crc, values["doc_tokens"], int(first + part_key - part[0]), int(place), ids))
                at += p
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PLACED, strict=True)], schema=_PLACED)


def pack_documents(
    docs: DataFrame, path: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every document's ids, ``end_id`` behind them, in sequences of at most ``window`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, ``with_ids``, the
    ids as little-endian 32-bit integers. NULL and empty texts are the end id alone; a NULL id stays NULL;
    repeated rows are packed once each; other columns are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    cut = store(source.mapInArrow(partial(_cut, path=path, window=window, end_id=end_id, with_ids=with_ids), _PIECE_DDL), "pieces")
    # One row per task and length: the hot lengths are counted before anything moves.
    counts = store(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row per length
        histogram[r["length"]] = r["n"]
    plan = plan_windows(histogram, window)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("long").alias("before"))
    placed = cut.join(before, ["task", "length"]).mapInArrow(partial(_place, plan=plan), _PLACED_DDL)
    return placed if with_ids else placed.drop("ids")
