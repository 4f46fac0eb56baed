"""Column helpers: strings, patterns, dates, maths, hashing, arrays, JSON, conditionals."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text patterns of the corpus cleaning step.
EMAIL_PATTERN = r"[\w\.-]+@[\w\.-]+"
PARENTHESES_PATTERN = r"\([^()]*\)"
HEADER_WORDS = ("From: ", "\nSubject: ")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# strings
def concat_text(*parts: Column | str) -> Column:
    return F.concat(*[_col(p) for p in parts])


def name_and_type(name: Column | str, kind: Column | str) -> Column:
    """``"name type"`` text of one column description."""
    return F.format_string("%s %s", _col(name), _col(kind))


def tail_from(text: Column | str, marker: str) -> Column:
    """The text from the first ``marker`` on; NULL when the marker is absent."""
    text = _col(text)
    at = F.instr(text, marker)
    return F.when(at > 0, F.substring(text, at, F.length(text)))


def truncate_text(text: Column | str, n: int) -> Column:
    return F.left(_col(text), F.lit(n))


# patterns
def strip_emails(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), EMAIL_PATTERN, "")


def strip_parentheses(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), PARENTHESES_PATTERN, "")


# dates
def week_starting_friday(day: Column | str) -> Column:
    """First day of the week that starts on Friday."""
    day = _col(day)
    return F.date_sub(day, (F.dayofweek(day) + 1) % 7)


def shift_years(day: Column | str, years: Column | int) -> Column:
    years = F.lit(years) if isinstance(years, int) else years
    return F.add_months(_col(day), years * 12)


def shift_weeks(day: Column | str, weeks: Column | int) -> Column:
    weeks = F.lit(weeks) if isinstance(weeks, int) else weeks
    return F.date_add(_col(day), (weeks * 7).cast("int"))


def iso_week(day: Column | str) -> Column:
    return F.weekofyear(_col(day))


# maths
def round_to_int(x: Column | str) -> Column:
    """Integer by rounding, not truncation."""
    return F.round(_col(x)).cast("bigint")


def divide(a: Column, b: Column, otherwise: float | None = None) -> Column:
    """``a / b`` that yields ``otherwise`` instead of failing when ``b`` is 0."""
    quotient = a / F.nullif(b.cast("double"), F.lit(0.0))
    return quotient if otherwise is None else F.when(a.isNotNull() & (b == 0), F.lit(otherwise)).otherwise(quotient)


def normal_confidence(k: float) -> float:
    """Percent of a normal law within k standard deviations."""
    return 100.0 * math.erf(k / math.sqrt(2.0))


# seeded random columns
def hash_uniform(key: Column | str, seed: str | int) -> Column:
    """Uniform number in [0, 1) that depends on key and seed alone, not on the partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def box_muller(key: Column | str, seed: str | int, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Normal variate from two hash uniforms of the key."""
    u1 = F.greatest(hash_uniform(key, f"{seed}.1"), F.lit(1e-12))
    u2 = hash_uniform(key, f"{seed}.2")
    return F.lit(mean) + F.lit(sd) * F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


# arrays
def arg_max(values: Column | str) -> Column:
    """0-based position of the largest element."""
    values = _col(values)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def sort_pairs(keys: Column | str, values: Column | str, descending: bool = False) -> Column:
    """Two arrays sorted together by the first, as an array of structs (key, value)."""
    pairs = F.arrays_zip(_col(keys).alias("key"), _col(values).alias("value"))
    return F.sort_array(pairs, asc=not descending)


# JSON
PREDICTION_SCHEMA = T.ArrayType(
    T.StructType(
        [T.StructField("embeddings", T.StructType([T.StructField("values", T.ArrayType(T.DoubleType()))]))]
    )
)


def json_vectors(payload: Column | str) -> Column:
    """Array of embedding vectors in a prediction payload."""
    return F.from_json(_col(payload), PREDICTION_SCHEMA)["embeddings"]["values"]


# conditionals
def case_piecewise(x: Column | str, centre: float, above: float, below: float) -> Column:
    """Two-sided linear penalty around ``centre``: slope ``above`` to the right, ``below`` to the left."""
    distance = _col(x) - F.lit(centre)
    return F.when(distance > 0, distance * above).otherwise(-distance * below)


def clamp_round(x: Column | str, low: float = 0.0, high: float = 100.0) -> Column:
    """Rounded value held inside [low, high]."""
    x = _col(x)
    return F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(F.round(x))
