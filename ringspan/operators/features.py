"""Feature transforms: fitted once on training rows, stored, applied to any rows."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso_week
from ..session import scratch_path
from .aggregates import column_stats, quantile_exact
from .ordered import SMALL_ROWS, row_number


@dataclass(frozen=True)
class Spec:
    """One input column, what to do with it, and the output name."""

    kind: str
    column: str
    out: str
    ddof: int = 1


def standard_scaler(column: str, out: str | None = None, ddof: int = 1) -> Spec:
    return Spec("standard", column, out or column, ddof)


def min_max_scaler(column: str, out: str | None = None) -> Spec:
    return Spec("min_max", column, out or column)


def robust_scaler(column: str, out: str | None = None) -> Spec:
    return Spec("robust", column, out or column)


def max_abs_scaler(column: str, out: str | None = None) -> Spec:
    return Spec("max_abs", column, out or column)


def label_encoder(column: str, out: str | None = None) -> Spec:
    return Spec("label", column, out or column)


def date_features(column: str, out: str | None = None) -> Spec:
    """Year and ISO week, as ``<out>_year`` and ``<out>_week``."""
    return Spec("date", column, out or column)


def pass_through(column: str, out: str | None = None) -> Spec:
    return Spec("pass", column, out or column)


# kind -> names of the statistics that are subtracted, and of the two whose difference divides
SCALERS = {
    "standard": ("mean", None),
    "min_max": ("min", ("max", "min")),
    "robust": ("q50", ("q75", "q25")),
    "max_abs": (None, ("max_abs", None)),
}


def _scaled(spec: Spec, stats: dict) -> Column:
    """(x - centre) / spread with the fitted numbers as literals; 0 where there is no spread."""
    centre, spread = SCALERS[spec.kind]
    if spec.kind == "standard":
        width = stats["std" if spec.ddof else "std_pop"]
    else:
        high, low = spread
        width = None if stats[high] is None else stats[high] - (stats[low] if low else 0.0)
    x = F.col(spec.column).cast("double")
    if not width:
        return F.when(x.isNotNull(), F.lit(0.0))
    shift = stats[centre] if centre else 0.0
    return (x - F.lit(float(shift))) / F.lit(float(width))


def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("string").alias("value")).filter(F.col("value").isNotNull()).distinct()


def encode_labels(df: DataFrame, column: str) -> DataFrame:
    """(value, code): distinct values numbered from 1 in alphabetical order, for any number of them."""
    return row_number(distinct_labels(df, column), ["value"], "code")


@dataclass
class FittedTransform:
    """Literal statistics and category codes; ``transform`` is one projection plus lookups."""

    specs: list[Spec]
    stats: dict = field(default_factory=dict)
    codes: dict = field(default_factory=dict)  # column -> {value: code}
    code_tables: dict = field(default_factory=dict)  # column -> parquet path, for many categories

    @property
    def outputs(self) -> list[str]:
        names = []
        for s in self.specs:
            names += [f"{s.out}_year", f"{s.out}_week"] if s.kind == "date" else [s.out]
        return names

    def without(self, output: str) -> FittedTransform:
        """The same transform without the spec of one output, such as a label that new rows lack."""
        return FittedTransform([s for s in self.specs if s.out != output], self.stats, self.codes, self.code_tables)

    def columns(self, names: Sequence[str]) -> list[Column]:
        """Scaled columns as expressions, for scalers only."""
        by_name = {s.out: s for s in self.specs}
        return [_scaled(by_name[n], self.stats[by_name[n].column]) for n in names]

    def _codes_of(self, spark: SparkSession, column: str) -> DataFrame:
        if column in self.code_tables:
            return spark.read.parquet(self.code_tables[column])
        rows = list(self.codes[column].items())
        return F.broadcast(spark.createDataFrame(rows, "value string, code bigint"))

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The transformed columns (and the columns in ``keep``); all other inputs are dropped."""
        encoded = [s for s in self.specs if s.kind == "label"]
        for s in encoded:
            codes = self._codes_of(df.sparkSession, s.column).select(
                F.col("value").alias(f"_value_{s.column}"), F.col("code").alias(f"_code_{s.column}")
            )
            df = df.join(codes, F.col(s.column).cast("string") == F.col(f"_value_{s.column}"), "left")
        cols = [F.col(c) for c in keep]
        for s in self.specs:
            if s.kind == "pass":
                cols.append(F.col(s.column).alias(s.out))
            elif s.kind == "label":
                cols.append(F.coalesce(F.col(f"_code_{s.column}"), F.lit(0).cast("bigint")).alias(s.out))
            elif s.kind == "date":
                cols += [F.year(s.column).alias(f"{s.out}_year"), iso_week(s.column).alias(f"{s.out}_week")]
            else:
                cols.append(_scaled(s, self.stats[s.column]).alias(s.out))
        return df.select(*cols)

    def to_json(self) -> str:
        return json.dumps(
            {"specs": [asdict(s) for s in self.specs], "stats": self.stats, "codes": self.codes,
             "code_tables": self.code_tables}
        )

    @classmethod
    def from_json(cls, text: str) -> FittedTransform:
        state = json.loads(text)
        return cls([Spec(**s) for s in state["specs"]], state["stats"], state["codes"], state["code_tables"])

    def save(self, spark: SparkSession, path: str) -> None:
        """JSON text at ``path``; category tables move next to it."""
        tables = {}
        for column, source in self.code_tables.items():
            tables[column] = f"{path}/codes-{column}"
            spark.read.parquet(source).write.mode("overwrite").parquet(tables[column])
        state = FittedTransform(self.specs, self.stats, self.codes, tables)
        spark.createDataFrame([(state.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedTransform:
        return cls.from_json(spark.read.text(f"{path}/state").first()[0])


@dataclass
class FeatureTransform:
    """A named list of column specs."""

    specs: list[Spec]

    def fit(self, df: DataFrame) -> FittedTransform:
        """One aggregate job for all scalers (plus ranks when a robust one asks for quartiles)."""
        fitted = FittedTransform(list(self.specs))
        scaled = sorted({s.column for s in self.specs if s.kind in SCALERS})
        robust = sorted({s.column for s in self.specs if s.kind == "robust"})
        if scaled:
            for row in column_stats(df, scaled, quantiles=False).collect():  # one row per column
                stats = row.asDict()
                fitted.stats[stats.pop("column")] = stats
        if robust:
            for c in robust:
                fitted.stats[c].update(q25=None, q50=None, q75=None)
            for row in quantile_exact(df, robust, [0.25, 0.5, 0.75]).collect():  # three rows per column
                fitted.stats[row["column"]][f"q{round(row['prob'] * 100)}"] = row["value"]
        for s in self.specs:
            if s.kind == "label" and s.column not in fitted.codes and s.column not in fitted.code_tables:
                self._fit_codes(df, s.column, fitted)
        return fitted

    @staticmethod
    def _fit_codes(df: DataFrame, column: str, fitted: FittedTransform) -> None:
        values = distinct_labels(df, column).limit(SMALL_ROWS + 1).collect()
        if len(values) <= SMALL_ROWS:
            ordered = sorted(r["value"] for r in values)
            fitted.codes[column] = {value: code for code, value in enumerate(ordered, 1)}
        else:
            path = scratch_path(df.sparkSession, f"codes-{column}")
            encode_labels(df, column).write.parquet(path)
            fitted.code_tables[column] = path


def normalize(df: DataFrame, cols: Sequence[str], ddof: int = 1) -> DataFrame:
    """Columns replaced by their standard scores; every other column stays."""
    specs = [standard_scaler(c, ddof=ddof) for c in cols]
    stats = FeatureTransform(specs).fit(df).stats
    return df.withColumns({s.column: _scaled(s, stats[s.column]) for s in specs})


def scale_over_all(df: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """Scalers over the whole table without a window: statistics first, then plain arithmetic per row."""
    fitted = FeatureTransform(list(specs)).fit(df)
    return df.withColumns({s.out: _scaled(s, fitted.stats[s.column]) for s in specs})


def assemble_vector(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def disassemble_vector(df: DataFrame, vec: str, cols: Sequence[str]) -> DataFrame:
    """Vector elements back as columns of these names."""
    array = vector_to_array(F.col(vec))
    return df.withColumns({c: array[i] for i, c in enumerate(cols)}).drop(vec)


def feature_info(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per input column: min, max, mean, median, stddev, category count and null count."""
    numeric_types = ("tinyint", "smallint", "int", "bigint", "float", "double")
    kinds = dict(df.dtypes)
    numeric = [c for c in cols if kinds[c] in numeric_types or kinds[c].startswith("decimal")]
    texts = [c for c in cols if c not in numeric]
    parts = []
    if numeric:
        parts.append(
            column_stats(df, numeric).select(
                F.col("column").alias("input"), "min", "max", "mean", F.col("q50").alias("median"),
                F.col("std").alias("stddev"), F.lit(None).cast("bigint").alias("category_count"),
                F.col("nulls").alias("null_count"),
            )
        )
    if texts:
        pairs = [F.struct(F.lit(c).alias("input"), F.col(c).cast("string").alias("value")) for c in texts]
        per_value = df.select(F.inline(F.array(*pairs))).groupBy("input", "value").agg(F.count(F.lit(1)).alias("n"))
        none = [F.lit(None).cast("double").alias(n) for n in ("min", "max", "mean", "median", "stddev")]
        parts.append(
            per_value.groupBy("input").agg(
                F.count("value").alias("category_count"),
                F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            ).select("input", *none, "category_count", "null_count")
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
