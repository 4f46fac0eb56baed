"""Order-dependent operators without a single-task window: numbering, running sums, top-k, samples, splits.

A window over the whole table, or over one hot group, would run in one task. Here the rows are dealt to ranges of
the order itself, each range is summed on its own, and what lies before a range is written into the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import hash_uniform
from .ranges import SALTS, Ranges, row_bytes, total

# Spark limits each partition before the shuffle when the rank bound stays below this setting's default.
GROUP_LIMIT = 1000
# A side may be broadcast up to this many rows and bytes.
SMALL_ROWS = 10_000
SMALL_BYTES = 8 << 20


def is_small(df: DataFrame, rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether a frame has at most ``rows`` rows and ``max_bytes`` bytes; no more rows than that are looked at.

    Give a stored frame: one that takes long to compute would be computed here too.
    """
    found = df.limit(rows + 1).select(row_bytes(df).alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("bytes")).first()
    return found["rows"] <= rows and (found["bytes"] or 0) <= max_bytes


def _as_cols(keys: Sequence[Column | str] | Column | str) -> list[Column]:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def _named(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def same_key(left: str, right: str, names: Sequence[str]) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`")) for n in names]
    )


def prefix_sum(
    df: DataFrame, value: Column, order_by: Sequence[Column | str], by: Sequence[str] = (), out: str = "prefix",
    rows_per_range: int | None = None,
) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the group up to and including this one; NULL while there is none.

    ``order_by`` must be unique within a group for a determined result. Rows move once, to the range of their key.
    ``rows_per_range`` is how many rows, or fewer, are not worth parting.
    """
    by, order = list(by), _as_cols(order_by)
    ranges = Ranges(df, value, by, order, rows_per_range)
    here = f"{ranges.prefix}here"
    inside = Window.partitionBy(*_named(by), ranges.place).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = f"{ranges.prefix}before"
    rows = ranges.placed(df).withColumn(before, ranges.carried()).withColumn(here, F.sum(value).over(inside))
    return ranges.bare(rows.withColumn(out, total([F.col(before), F.col(here)])))


def row_number(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "row_number", by: Sequence[str] = (), rows_per_range: int | None = None
) -> DataFrame:
    """Sequential number from 1 in an explicit order, over all rows or per group."""
    return prefix_sum(df, F.lit(1).cast("bigint"), order_by, by, name, rows_per_range)


def running_sum(
    df: DataFrame, value: str, order_by: str, by: Sequence[str] = (), name: str = "running_sum"
) -> DataFrame:
    """Cumulative sum with the default frame: rows that tie on ``order_by`` share one total.

    The total of a key that is a bound, as every key with more rows than a range is, is known beforehand: its rows
    are dealt over several tasks and need none of the others.
    """
    by = list(by)
    ranges = Ranges(df, F.col(f"`{value}`"), by, _as_cols(order_by))
    bound, salt, known, here = (f"{ranges.prefix}{n}" for n in ("bound", "salt", "known", "here"))
    rows = ranges.placed(df).withColumn(bound, ranges.at_bound())
    rows = rows.withColumn(known, F.when(F.col(bound), ranges.ended()).otherwise(ranges.carried()))
    rows = rows.withColumn(salt, F.when(F.col(bound), F.pmod(F.xxhash64(*_named(df.columns)), F.lit(SALTS))))
    inside = Window.partitionBy(*_named(by), ranges.place, salt).orderBy(order_by).rangeBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn(here, F.sum(f"`{value}`").over(inside))
    result = F.when(F.col(bound), F.col(known)).otherwise(total([F.col(known), F.col(here)]))
    return ranges.bare(summed.withColumn(name, result))


def _first_of_runs(batches, by: list[int], k: int):
    """The first k rows of every run of rows that agree on the columns ``by``."""
    seen, last = 0, None
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        codes = [pc.fill_null(batch.column(i).dictionary_encode().indices, -1).to_numpy() for i in by]
        first = tuple(batch.column(i)[0].as_py() for i in by)
        starts = np.zeros(n, bool)
        starts[0] = first != last
        for c in codes:
            starts[1:] |= c[1:] != c[:-1]
        at = np.arange(n)
        since = np.maximum.accumulate(np.where(starts, at, -1))
        rank = np.where(since >= 0, at - since, seen + at)
        last, seen = tuple(batch.column(i)[n - 1].as_py() for i in by), int(rank[-1]) + 1
        yield batch.filter(pa.array(rank < k))


def top_k_per_group(
    df: DataFrame, by: Sequence[str] | str, order_by: Sequence[Column | str], k: int, rank: str | None = None
) -> DataFrame:
    """The k first rows of each group. Ties are broken by whatever ``order_by`` ends with.

    Every partition keeps its own k first rows of a group before the only exchange, so a hot group sends k rows a
    task. Spark plans that for a small k itself; for a larger one each partition is sorted and read once.
    """
    by = [by] if isinstance(by, str) else list(by)
    order = _as_cols(order_by)
    name = rank or fresh("_rank", df.columns)
    if k >= GROUP_LIMIT:
        here = df.sortWithinPartitions(*_named(by), *order)
        df = here.mapInArrow(partial(_first_of_runs, by=[df.columns.index(c) for c in by], k=k), df.schema)
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*_named(by)).orderBy(*order))).filter(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def order_by(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*_as_cols(keys))


def limit_n(df: DataFrame, n: int, order_by: Sequence[Column | str]) -> DataFrame:
    """The first n rows in an explicit order."""
    return df.orderBy(*_as_cols(order_by)).limit(n)


def sample_per_group(df: DataFrame, by: Sequence[str] | str, n: int, key: str, seed: str | int) -> DataFrame:
    """n random rows per group; the same rows for the same seed under any partitioning."""
    return top_k_per_group(df, by, [hash_uniform(key, seed), F.col(key)], n)


def sample_n(df: DataFrame, n: int, key: str, seed: str | int) -> DataFrame:
    """n random rows of the table."""
    return limit_n(df, n, [hash_uniform(key, seed), F.col(key)])


def train_test_split(df: DataFrame, fraction: float, key: str, seed: str | int) -> tuple[DataFrame, DataFrame]:
    """(train, test); ``fraction`` of the keys, by hash, goes to train, and rows without a key to test."""
    first = F.coalesce(hash_uniform(key, seed) < fraction, F.lit(False))
    return df.filter(first), df.filter(~first)
