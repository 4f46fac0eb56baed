"""Training with a quality gate: fit, evaluate, compare, decide, store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.anomaly import compare_models, evaluate, fit_threshold, metric_rows, validate_scored_rows
from ..operators.autoencoder import AutoencoderModel, fit_autoencoder
from ..operators.columns import union_all
from ..session import cut_lineage


@dataclass(frozen=True)
class GateParams:
    """The deploy threshold, metric and contamination of the published configuration."""

    cols: Sequence[str]
    threshold: float = 15.0
    metric: str = "mean_squared_error"
    contamination: float = 0.04
    challenger: Mapping = field(default_factory=dict)
    model_path: str | None = None
    held_out: float = 0.2


def _probe(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One complete row, the same in every run: the means of the inputs."""
    return rows.agg(*[F.avg(c).alias(c) for c in cols])


def train_gate(
    anomalies: DataFrame, normals: DataFrame, params: GateParams, blessed: AutoencoderModel | None = None
) -> tuple[DataFrame, AutoencoderModel]:
    """(decision, challenger): both models are measured on the same held-out rows; the better one is
    deployed when it passes the threshold, and a winning challenger is stored.
    """
    cols = list(params.cols)
    rows = union_all(anomalies.select(*cols), normals.select(*cols))
    rows = cut_lineage(rows.withColumn("_u", F.pmod(F.xxhash64(*cols), F.lit(10_000)) / 10_000))
    train, test = rows.filter(F.col("_u") >= params.held_out).drop("_u"), rows.filter(F.col("_u") < params.held_out).drop("_u")
    challenger = fit_autoencoder(train, cols, **params.challenger)
    fit_threshold(challenger, train, params.contamination)
    metrics = metric_rows(evaluate(challenger, test), "challenger")
    if blessed is not None:
        metrics = metrics.unionByName(metric_rows(evaluate(blessed, test), "blessed"))
    metrics = cut_lineage(metrics)
    decision = compare_models(metrics, params.metric, params.threshold)
    chosen = decision.first()
    if chosen["deploy"]:
        validate_scored_rows(challenger if chosen["best_model"] == "challenger" else blessed, _probe(rows, cols))
        if params.model_path and chosen["best_model"] == "challenger":
            challenger.save(params.model_path)
    return decision, challenger
