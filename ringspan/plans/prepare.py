"""The call-quality preparation job: read, clean, locate, label, normalise, write."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import (
    CALL_ALIASES, UNUSED_CALL_COLUMNS, canonical_columns, cast_columns, drop_columns, drop_null_rows,
    filter_valid_country, label_calls, numeric_columns,
)
from ..operators.features import FeatureTransform, normalize, standard_scaler
from ..operators.joins import country_of_number
from ..session import build_session, store
from ..sources.readers import CALL_SCHEMA, scan_csv
from ..sources.writers import write_csv


@dataclass(frozen=True)
class PrepareParams:
    """Where to read and write, and the decisions the rules leave open."""

    input: str
    output: str | None = None
    anomaly_output: str | None = None
    normal_output: str | None = None
    anomaly_normalized_output: str | None = None
    normal_normalized_output: str | None = None
    scope: str = "union"  # one scaler for both classes, or 'per_class'
    method: str = "exact"
    exclude: Sequence[str] = ("day", "hour")
    rejected_output: str | None = None  # rows that do not fit the schema, as they stand in the input


#: Identifiers are text whatever they look like: leading zeros count, and they are never scaled.
IDENTIFIERS = ("call_id", "organization_id", "from_number", "to_number")
_REJECTED = "_rejected"


def call_schema(columns: Sequence[str]) -> T.StructType:
    """The declared types for the columns of a header, under whichever name each appears; others are text."""
    declared = {f.name: f.dataType for f in CALL_SCHEMA.fields}
    for name, variants in CALL_ALIASES.items():
        kind = next((declared[n] for n in (name, *variants) if n in declared), T.StringType())
        declared |= dict.fromkeys((name, *variants), kind)
    return T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in columns])


def read_calls(spark: SparkSession, params: PrepareParams) -> DataFrame:
    """The typed rows of the input, stored; what does not fit goes to ``rejected_output`` if that is given."""
    header = spark.read.option("header", True).csv(params.input).columns
    rows = store(scan_csv(spark, params.input, call_schema(header), corrupt_col=_REJECTED), "calls")
    if params.rejected_output:
        rows.filter(F.col(_REJECTED).isNotNull()).select(F.col(_REJECTED).alias("value")).write.mode("overwrite").text(params.rejected_output)
    return rows.filter(F.col(_REJECTED).isNull()).drop(_REJECTED)


def locate_calls(raw: DataFrame, legacy_numbers: bool = False) -> DataFrame:
    """Canonical, complete call records whose numbers both have a country, as one lazy plan without a shuffle."""
    df = drop_columns(canonical_columns(raw), UNUSED_CALL_COLUMNS)
    df = drop_null_rows(cast_columns(df, {c: "string" for c in IDENTIFIERS if c in df.columns}))
    df = country_of_number(df, "from_number", out="from_country", legacy=legacy_numbers)
    df = country_of_number(df, "to_number", out="to_country", legacy=legacy_numbers)
    df = filter_valid_country(df)
    if "start_time" in df.columns:
        df = df.withColumns({"day": F.dayofmonth("start_time"), "hour": F.hour("start_time")})
    return df


def prepare_calls(raw: DataFrame, method: str = "exact", legacy_numbers: bool = False) -> DataFrame:
    """Located and labelled call records.

    The located rows are stored once; fitting the thresholds then reads three of their columns.
    """
    return label_calls(store(locate_calls(raw, legacy_numbers), "located"), method=method)


def normalize_calls(labelled: DataFrame, cols: Sequence[str], scope: str = "union") -> DataFrame:
    """Labelled rows with standardised numbers; one scaler for both classes, or one per class."""
    known = labelled.filter(F.col("label") != "none")
    if scope == "union":
        return normalize(known, cols)
    if scope != "per_class":
        raise ValueError("scope is 'union' or 'per_class'")
    parts = [normalize(known.filter(F.col("label") == name), cols) for name in ("anomaly", "normal")]
    return parts[0].unionByName(parts[1])


def run_prepare(spark: SparkSession, params: PrepareParams) -> DataFrame:
    """The whole job. The input is parsed once and the outputs are written from stored rows."""
    labelled = prepare_calls(read_calls(spark, params), params.method)
    if params.output:
        labelled.write.mode("overwrite").partitionBy("label").parquet(params.output)
        labelled = spark.read.parquet(params.output)
    cols, _ = numeric_columns(labelled, [*params.exclude, *IDENTIFIERS])
    scaled = normalize_calls(labelled, cols, params.scope)
    targets = [
        (labelled, "anomaly", params.anomaly_output), (labelled, "normal", params.normal_output),
        (scaled, "anomaly", params.anomaly_normalized_output), (scaled, "normal", params.normal_normalized_output),
    ]
    for frame, label, path in targets:
        if path:
            write_csv(frame.filter(F.col("label") == label).drop("label"), path)
    return labelled


def main(arguments: Sequence[str] | None = None) -> None:
    """``python -m ringspan.plans.prepare --input ... --output ...``: one option per field of PrepareParams."""
    parser = argparse.ArgumentParser(description=run_prepare.__doc__)
    for f in fields(PrepareParams):
        option = f"--{f.name.replace('_', '-')}"
        if f.name == "exclude":
            parser.add_argument(option, nargs="*", default=list(f.default))
        else:
            parser.add_argument(option, required=f.name == "input", default=None if f.name == "input" else f.default)
    run_prepare(build_session("prepare"), PrepareParams(**vars(parser.parse_args(arguments))))


def fit_call_scaler(labelled: DataFrame, cols: Sequence[str]):
    """The scaler of the labelled rows, to be applied to any later rows."""
    return FeatureTransform([standard_scaler(c) for c in cols]).fit(labelled.filter(F.col("label") != "none"))


if __name__ == "__main__":
    main()
