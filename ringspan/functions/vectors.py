"""Array-valued vectors: distances between them, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fold(a: Column, b: Column, term) -> Column:
    return F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda acc, x: acc + x)


def vector_dot(a: Column | str, b: Column | str) -> Column:
    return _fold(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))


def vector_norm(a: Column | str) -> Column:
    return F.sqrt(vector_dot(a, a))


def vector_distance(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance; NULL when the lengths differ."""
    return F.sqrt(
        _fold(_col(a), _col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    )


def constant_vector(value: float, size: int) -> Column:
    return F.array_repeat(F.lit(float(value)), size)
