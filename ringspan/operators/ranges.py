"""Ranges of an order as an expression: a row's range follows from its key and from bounds written into the plan.

Bounds come from a sample of the keys (samples of parts merge by union, so it is taken where the rows lie). What
lies before a range is one number per range, because a bound parts at most one group: the totals are summed where
the rows lie and written into the plan beside the bounds. No row is stored, and rows move once, to their range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import partitions_for, size_of

#: Rows or bytes that are worth a range of their own.
ROWS_PER_RANGE = 500_000
BYTES_PER_RANGE = 128 << 20
#: Sampled keys per range, and the most that are sampled for however many ranges.
SAMPLES_PER_RANGE = 40
MOST_SAMPLES = 400_000
#: Parts over which the rows of a bound's own key are dealt when all their results are known beforehand.
SALTS = 64

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _parsed(df: DataFrame, order: Column) -> tuple[Column, bool, bool]:
    """(expression, descending, NULL first) of an ordering."""
    node = order._jc.node()
    if node.getClass().getSimpleName() != "SortOrder":
        return order, False, True
    child = Column(df.sparkSession._jvm.org.apache.spark.sql.Column(node.child()))
    last = node.nullOrdering().getClass().getSimpleName().startswith("NullsLast")
    return child, node.sortDirection().getClass().getSimpleName().startswith("Desc"), not last


def _ascending(df: DataFrame, order: Column) -> list[Column]:
    """Columns whose ascending order, one after the other, is ``order``; each of a type a literal can hold exactly."""
    x, down, nulls_first = _parsed(df, order)
    kind = df.select(x.alias("x")).schema[0].dataType
    flag = F.when(x.isNull(), 0 if nulls_first else 1).otherwise(1 if nulls_first else 0)
    extra: list[Column] = []
    if isinstance(kind, T.BooleanType):
        x = x.cast("int")
    elif isinstance(kind, T.DateType):
        x = F.unix_date(x)
    elif isinstance(kind, T.TimestampType):
        x = F.unix_micros(x)
    elif isinstance(kind, T.TimestampNTZType):
        x = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), x)
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        # The hexadecimal digits the other way round, and an end above them all, so that a beginning comes later.
        x = F.concat(F.translate(F.hex(x), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G")) if down else x
        return [flag, x]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        if down:
            extra, x = [F.when(F.isnan(x), 0).otherwise(1)], F.when(~F.isnan(x), -x)
        return [flag, *extra, x]
    elif isinstance(kind, T.DecimalType):
        return [flag, -x if down else x]
    elif not isinstance(kind, _WHOLE):
        raise ValueError(f"no ranges over {kind.simpleString()}")
    # Not -x: the least number has no negative.
    return [flag, F.bitwise_not(x.cast("bigint")) if down else x.cast("bigint")]


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: the length of texts and of what nests them, 8 for anything else."""

    def size(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0))
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        return F.lit(8)

    return reduce(lambda a, b: a + b, [size(f) for f in df.schema.fields], F.lit(0).cast("bigint"))


class Ranges:
    """Bounds of the (group, order) keys of a frame, with the totals of ``value`` before and upto every bound.

    The frame is read three times (count, sample, totals), key and value columns only, so it should be cheap to read
    or stored, and it must give the same rows every time.
    """

    def __init__(self, df: DataFrame, value: Column, by: Sequence[str], order: Sequence[Column], rows_per_range: int | None = None):
        groups = [k for c in by for k in _ascending(df, F.col(f"`{c}`"))]
        self.keys = groups + [k for o in order for k in _ascending(df, o)]
        self.n_groups, self.value = len(groups), value
        self.rows_per_range = rows_per_range or ROWS_PER_RANGE
        self.prefix = "_r"
        while any(c.lower().startswith(self.prefix) for c in df.columns):
            self.prefix += "_"
        self.columns = df.columns
        self.place = F.col(f"{self.prefix}place")
        self.bounds, self.types = self._bounds(df)
        self.upto, self.total_type = self._totals(df) if self.bounds else ([], None)

    def _bounds(self, df: DataFrame) -> tuple[list[tuple], list[T.DataType]]:
        size, parts = size_of(df), partitions_for(df)
        if size:
            rows = df.count()
        else:
            # The optimizer knows no size where any part of the frame was made row by row: few rows may be large.
            rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
            parts = max(parts, -(-size // BYTES_PER_RANGE))
        ranges = min(parts, rows // self.rows_per_range + size // BYTES_PER_RANGE + 1)
        if rows == 0 or ranges < 2:
            return [], []
        wanted = min(ranges * SAMPLES_PER_RANGE, MOST_SAMPLES)
        names = [f"k{i}" for i in range(len(self.keys))]
        keys = df.select(*[k.alias(n) for k, n in zip(self.keys, names, strict=True)])
        # The fraction leaves a bounded number of keys: one task orders them.
        sample = keys.sample(min(1.0, wanted / rows), seed=17) if rows > wanted else keys
        placed = sample.select(*names, F.row_number().over(Window.orderBy(*names)).alias("at"))
        step = max(1, min(wanted, rows) // ranges)
        chosen = placed.filter(F.col("at") % step == 0).select(*names).distinct().orderBy(*names)
        return [tuple(r) for r in chosen.collect()], [f.dataType for f in chosen.schema]

    def _array(self, parts: int) -> Column:
        """The first parts of all bounds."""
        fields = [(f"k{i}", t) for i, t in enumerate(self.types)][:parts]
        return F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(b, fields, strict=False)]) for b in self.bounds])

    def _struct(self, parts: int) -> Column:
        return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(self.keys[:parts])])

    def _agree(self, at: Column, parts: int) -> Column:
        """Whether the first parts of the row's key are those of the bound at a place, if there is one."""
        if not parts:
            return (at >= 0) & (at < len(self.bounds))
        return F.coalesce(F.get(self._array(parts), F.when(at >= 0, at)) == self._struct(parts), F.lit(False))

    def placed(self, df: DataFrame) -> DataFrame:
        """The frame with ``place``, the number of bounds before the row's key, by binary search."""
        n = len(self.bounds)
        if not n:
            return df.withColumn(f"{self.prefix}place", F.lit(0))
        bounds, steps = self._array(len(self.keys)), F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
        further = lambda at, step, key: (at + step <= n) & (F.get(bounds, at + step - 1) < key)
        search = lambda key: F.aggregate(steps, F.lit(0), lambda at, step: F.when(further(at, step, key), at + step).otherwise(at))
        # As an element the key is made once, not at every step.
        return df.withColumn(f"{self.prefix}place", F.get(F.transform(F.array(self._struct(len(self.keys))), search), 0))

    def bare(self, df: DataFrame) -> DataFrame:
        """Without the columns that ``placed`` added."""
        return df.drop(*[c for c in df.columns if c not in self.columns and c.startswith(self.prefix)])

    def _totals(self, df: DataFrame) -> tuple[list, T.DataType]:
        """For every bound the total of its group's values upto the end of its range."""
        part = F.when(self._agree(self.place, self.n_groups), self.value)
        found = self.placed(df).filter(self.place < len(self.bounds)).groupBy(self.place.alias("at")).agg(F.sum(part).alias("s"))
        sums = {r["at"]: r["s"] for r in found.collect()}
        upto: list = []
        for i, bound in enumerate(self.bounds):
            own, earlier = sums.get(i), upto[-1] if i and bound[: self.n_groups] == self.bounds[i - 1][: self.n_groups] else None
            upto.append(earlier if own is None else own if earlier is None else earlier + own)
        return upto, found.schema["s"].dataType

    def carried(self) -> Column:
        """What the row's group holds before the row's range; NULL if nothing."""
        return F.when(self._agree(self.place - 1, self.n_groups), self.ended(self.place - 1)) if self.bounds else F.lit(None)

    def at_bound(self) -> Column:
        """Whether the row's key is the bound that ends its range."""
        return self._agree(self.place, len(self.keys)) if self.bounds else F.lit(False)

    def ended(self, place: Column | None = None) -> Column:
        """The total of the group upto the bound that ends the row's range."""
        place = self.place if place is None else place
        return F.get(F.array(*[F.lit(v).cast(self.total_type) for v in self.upto]), place) if self.bounds else F.lit(None)


def total(parts: Sequence[Column]) -> Column:
    """The sum of the parts that are not NULL; NULL if all are."""
    some = reduce(lambda a, b: a | b, [p.isNotNull() for p in parts])
    return F.when(some, reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts]))
