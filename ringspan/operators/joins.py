"""Joins, lookups, products with a small side, and number-to-country resolution."""

from __future__ import annotations

import csv
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordered import SMALL_BYTES, SMALL_ROWS, is_small


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint behind a check of rows and bytes; a larger side is left to the planner and its skew handling."""
    return F.broadcast(df) if is_small(df, rows) else df


def join_using(a: DataFrame, b: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    return a.join(b, [on] if isinstance(on, str) else list(on), how)


def join_by_position(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Columns that would be joined on their row position, computed side by side on the rows instead.

    Any expression of the row's own key may be given; there is no join and no shuffle.
    """
    return rows.withColumns(dict(columns))


def cross_join(a: DataFrame, b: DataFrame, broadcast_bytes: int = SMALL_BYTES) -> DataFrame:
    """Every row of ``a`` with every row of ``b``.

    A ``b`` of few rows and at most ``broadcast_bytes`` becomes a generator over an array of its rows, and ``a`` stays
    where it is; a larger one becomes a product of partitions, which is as large as it is asked to be.
    """
    if not is_small(b, max_bytes=broadcast_bytes):
        return a.crossJoin(b)
    rows = b.agg(F.collect_list(F.struct("*"))).scalar()
    return a.select("*", F.explode(rows).alias("_row")).select(*[F.col(f"`{c}`") for c in a.columns], "_row.*")


def join_left_multi_key(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on several keys; columns of ``b`` are NULL where nothing matches."""
    return a.join(b, list(on), "left")


def join_unnest(df: DataFrame, array_col: str, as_: str, position: str | None = None, outer: bool = False) -> DataFrame:
    """One row per array element; ``outer`` keeps rows with an empty array."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != array_col]
    if position:
        explode = F.posexplode_outer if outer else F.posexplode
        return df.select(*kept, explode(array_col).alias(position, as_))
    explode = F.explode_outer if outer else F.explode
    return df.select(*kept, explode(array_col).alias(as_))


def lookup_label(df: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    """The name of each id; unknown ids get NULL."""
    return df.join(broadcast_if_small(dim.select(key, name)), key, "left")


def join_centroid(df: DataFrame, centroids: DataFrame, cls: str) -> DataFrame:
    """Each row with the centroid of its class."""
    return df.join(broadcast_if_small(centroids), cls, "inner")


def fetch_by_key(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Full rows for a batch of keys."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on), on, "left_semi")


CODES_FILE = os.path.join(os.path.dirname(__file__), "calling_codes.csv")


def calling_codes(path: str = CODES_FILE) -> dict[str, str]:
    """Prefix -> country, from a table of public numbering plans: calling codes, and the area codes behind 1 and 7."""
    with open(path, encoding="utf-8", newline="") as source:
        return {r["prefix"]: r["country"] for r in csv.DictReader(source)}


#: Above every character a number can hold, so that ``prefix + END`` ends the numbers that begin with ``prefix``.
END = "\U0010ffff"


def prefix_ranges(prefixes: Mapping[str, str]) -> tuple[list[str], list[str | None]]:
    """Starts of ranges in order, and the country of each: numbers from a start up to the next one belong to it.

    A longer prefix is a range inside that of a shorter one, whose country goes on behind it; None where no prefix
    reaches.
    """
    starts, countries, open_ = [], [], []
    marks = sorted([(p, 1, p) for p in prefixes] + [(p + END, 0, p) for p in prefixes], key=lambda m: (m[0], m[1], -len(m[2]) if m[1] == 0 else len(m[2])))
    for start, begins, prefix in marks:
        if begins:
            open_.append(prefix)
        else:
            open_.remove(prefix)
        country = prefixes[max(open_, key=len)] if open_ else None
        if starts and starts[-1] == start:
            countries[-1] = country
        else:
            starts.append(start)
            countries.append(country)
    return starts, countries


def _text_array(texts: Sequence[str]) -> Column:
    """A constant array of texts without control characters."""
    return F.split(F.lit("\x1f".join(texts)), "\x1f", -1)


def _in_ranges(number: Column, prefixes: Mapping[str, str]) -> Column:
    """The country of a number by binary search over the starts of the ranges."""
    starts, countries = prefix_ranges(prefixes)
    if not starts:
        return F.lit(None).cast("string")
    known = _text_array(starts)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(starts).bit_length()))])
    upto = lambda n: F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(starts)) & (F.get(known, at + step - 1) <= n), at + step).otherwise(at))
    names = _text_array(["\x00" if c is None else c for c in countries])
    # Each step reads the element of the one before, so that the number is made and searched once. NULL is before all.
    found = F.transform(F.transform(F.array(number), upto), lambda at: F.get(names, at - 1))
    return F.get(F.transform(found, lambda c: F.when(c != "\x00", c)), 0)


def _by_length(df: DataFrame, prefixes: DataFrame, digits: str, out: str) -> DataFrame:
    """One join per prefix length, longest first: for tables of prefixes too large to stand in an expression."""
    lengths = prefixes.select(F.length("prefix").alias("n")).distinct().collect()  # a handful of digits counts
    one, found = prefixes.groupBy("prefix").agg(F.min("country").alias("country")), []
    for n in sorted((r["n"] for r in lengths if r["n"] is not None), reverse=True):
        key, name = f"_key_{out}_{n}", f"_country_{out}_{n}"
        side = one.filter(F.length("prefix") == n).toDF(key, name)
        df = df.join(side, F.left(F.col(digits), F.lit(n)) == F.col(key), "left").drop(key)
        found.append(name)
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in found], F.lit(None).cast("string"))).drop(*found)


def country_of_number(
    df: DataFrame, col: str, prefixes: DataFrame | Mapping[str, str] | None = None,
    out: str = "country", legacy: bool = False,
) -> DataFrame:
    """Country of a phone number by its longest known calling-code prefix; NULL when there is none.

    The prefixes become ranges of digits in one sorted array, and a number is placed by binary search: no join, rows
    stay where they are. Only a table of more than 10,000 prefixes is joined, once per prefix length. The whole number
    behind the international prefix is compared.
    ``00`` in front is the international prefix and is stripped; with ``legacy`` such a number is
    read as a national one of code 1, zeros included.
    """
    text = F.col(col).cast("string")
    number = F.regexp_replace(F.regexp_replace(text, r"^\+", ""), "^00", "100") if legacy else F.regexp_replace(text, r"^\+?(?:00)?", "")
    prefixes = calling_codes() if prefixes is None else prefixes
    if isinstance(prefixes, DataFrame):
        if not is_small(prefixes):
            digits = f"_digits_{out}"
            return _by_length(df.withColumn(digits, number), prefixes, digits, out).drop(digits)
        known = prefixes.filter("prefix is not null and country is not null").groupBy("prefix").agg(F.min("country").alias("country"))
        prefixes = {r["prefix"]: r["country"] for r in known.collect()}  # at most 10,000, by the check above
    return df.withColumn(out, _in_ranges(number, {p: c for p, c in prefixes.items() if c is not None}))


def render_invalid(country: Column | str, text: str = "Invalid") -> Column:
    """The text form of an unresolved country."""
    return F.coalesce(F.col(country) if isinstance(country, str) else country, F.lit(text))
