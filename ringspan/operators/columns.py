"""Projection, cleaning, casting, filtering and labelling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from .aggregates import quantile_approx, quantile_exact

# Canonical call-record names and the variants they appear under.
CALL_ALIASES = {
    "from_number": ("e164_from_caller_id", "164_from_caller_id"),
    "to_number": ("e164_to_caller_id", "164_to_caller_id"),
    "mos": ("mean_opinion_score",),
    "duration": ("duration_seconds",),
}
# Columns the preparation job does not use.
UNUSED_CALL_COLUMNS = ("status", "data_center", "carrier_id", "label", "origination", "destination")


def canonical_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]] = CALL_ALIASES) -> DataFrame:
    """Rename variant columns to their canonical name; ValueError when neither is present."""
    renames = {}
    for name, variants in aliases.items():
        if name in df.columns:
            continue
        present = [v for v in variants if v in df.columns]
        if not present:
            raise ValueError(f"no column {name!r} and none of its variants {list(variants)}")
        renames[present[0]] = name
    return df.select([F.col(f"`{c}`").alias(renames.get(c, c)) for c in df.columns])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without a NULL (or NaN) in any of the columns; one condition each, so they reach the scan."""
    for f in df.schema.fields:
        if subset is None or f.name in subset:
            column = F.col(f"`{f.name}`")
            df = df.filter(column.isNotNull())
            if isinstance(f.dataType, (DoubleType, FloatType)):
                df = df.filter(~F.isnan(column))
    return df


def cast_columns(df: DataFrame, types: Mapping[str, str], try_: bool = True) -> DataFrame:
    """Cast named columns; a value that does not fit becomes NULL, or an error with ``try_=False``."""
    casts = {c: (F.col(c).try_cast(t) if try_ else F.col(c).cast(t)) for c, t in types.items()}
    return df.withColumns(casts)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, other) column names; excluded names are in neither of the two when numeric."""
    exclude = set(exclude)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    other = [f.name for f in df.schema.fields if f.name not in numeric]
    return [c for c in numeric if c not in exclude], other


def _cuts(df: DataFrame, wanted: Mapping[str, float], method: str) -> dict[str, float]:
    """A quantile per named column, all from one job: a fitted rule is a handful of numbers."""
    if method not in ("exact", "approx"):
        raise ValueError("method is 'exact' or 'approx'")
    find = quantile_exact if method == "exact" else quantile_approx
    quantiles = find(df, list(wanted), sorted(set(wanted.values())))
    rows = quantiles.collect()  # one row per column and probability
    found = {(r["column"], r["prob"]): r["value"] for r in rows}
    return {c: found.get((c, float(q))) for c, q in wanted.items()}


@dataclass(frozen=True)
class Thresholds:
    """The fitted cuts of both rules; None where a column had no values."""

    jitter_q50: float | None
    mos_q25: float | None
    duration_q50: float | None


def fit_thresholds(
    df: DataFrame, jitter_q: float = 0.5, mos_q: float = 0.25, duration_q: float = 0.5, method: str = "exact"
) -> Thresholds:
    cuts = _cuts(df, {"jitter": jitter_q, "mos": mos_q, "duration": duration_q}, method)
    return Thresholds(cuts["jitter"], cuts["mos"], cuts["duration"])


def _anomaly(jitter_cut: float | None, mos_cut: float | None, loss: float, inclusive: bool) -> Column:
    lossy = F.col("packet_loss") >= loss if inclusive else F.col("packet_loss") > loss
    return lossy & (F.col("jitter") > F.lit(jitter_cut)) & (F.col("mos") < F.lit(mos_cut))


def _normal(duration_cut: float | None, mos: float, jitter: float, loss: float) -> Column:
    long_call = F.col("duration") > F.lit(duration_cut)
    return long_call & (F.col("mos") > mos) & (F.col("jitter") <= jitter) & (F.col("packet_loss") <= loss)


def label_anomalies_rule(
    df: DataFrame, loss: float = 0.1, jitter_q: float = 0.5, mos_q: float = 0.25,
    method: str = "exact", inclusive: bool = False,
) -> DataFrame:
    """Rows with high packet loss, jitter above its quantile and a score below its quantile.

    The cuts are literals of the filter, so it reaches the scan.
    """
    cuts = _cuts(df, {"jitter": jitter_q, "mos": mos_q}, method)
    return df.filter(_anomaly(cuts["jitter"], cuts["mos"], loss, inclusive)).withColumn("is_anomaly", F.lit(True))


def label_normal_rule(
    df: DataFrame, duration_q: float = 0.5, mos: float = 4, jitter: float = 1, loss: float = 0, method: str = "exact"
) -> DataFrame:
    """Long calls with a high score, little jitter and no loss."""
    cut = _cuts(df, {"duration": duration_q}, method)["duration"]
    return df.filter(_normal(cut, mos, jitter, loss)).withColumn("is_anomaly", F.lit(False))


def label_calls(
    df: DataFrame, cuts: Thresholds | None = None, keep_unlabelled: bool = True, method: str = "exact",
    inclusive: bool = False,
) -> DataFrame:
    """Both rules in one pass over the rows: ``label`` is 'anomaly', 'normal' or 'none'.

    Cuts fitted elsewhere may be given; otherwise they are fitted on these rows.
    """
    cuts = cuts or fit_thresholds(df, method=method)
    anomaly = _anomaly(cuts.jitter_q50, cuts.mos_q25, 0.1, inclusive)
    normal = _normal(cuts.duration_q50, 4, 1, 0)
    out = df.withColumn("label", F.when(anomaly, "anomaly").when(normal, "normal").otherwise("none"))
    return out if keep_unlabelled else out.filter(F.col("label") != "none")


def filter_valid_country(df: DataFrame, cols: Sequence[str] = ("from_country", "to_country")) -> DataFrame:
    """Rows whose numbers all resolved to a country."""
    return df.dropna("any", subset=list(cols))


def filter_predicate(df: DataFrame, expr: Column | str) -> DataFrame:
    return df.filter(expr)


def filter_contains(df: DataFrame, col: str, text: str) -> DataFrame:
    return df.filter(F.col(col).contains(text))


def select_features(
    df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None
) -> DataFrame:
    """Columns to score: an include list, or everything but an exclude list."""
    if include is not None and exclude is not None:
        raise ValueError("give include or exclude, not both")
    if include is not None:
        return df.select(*include)
    return df.drop(*(exclude or ()))


def flag_rows(df: DataFrame, condition: Column, name: str = "is_anomaly") -> DataFrame:
    """Boolean column; rows on which the condition is unknown are not flagged."""
    return df.withColumn(name, F.coalesce(condition, F.lit(False)))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("cols", F.lit(len(df.columns)).cast("bigint"))


def compute_error(df: DataFrame, label: str, prediction: str, name: str = "error") -> DataFrame:
    return df.withColumn(name, F.col(label) - F.col(prediction))


def union_all(*frames: DataFrame) -> DataFrame:
    """Append tables of the same columns, matched by name."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=False)
    return first
