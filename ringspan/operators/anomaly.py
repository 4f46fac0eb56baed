"""Reconstruction errors, anomaly flags, agreement, and the choice between models."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .aggregates import quantile_exact, regression_metrics, sigma_thresholds
from .autoencoder import AutoencoderModel, Search
from .boosting import BoostedModel
from .columns import flag_rows
from .trees import TreeModel, predict

ERRORS = ("mean_absolute_error", "mean_squared_error", "mean_squared_log_error")


def reconstruction_loss(model: AutoencoderModel | Search, df: DataFrame, trial_id: int | None = None) -> DataFrame:
    """All rows with their reconstruction errors; NULL where an input is missing.

    Absolute and squared errors are on the scaled inputs. The log error is on the original ones, where
    values below zero count as zero.
    """
    if isinstance(model, Search):
        model = model.model(trial_id)
    n = len(model.cols)
    complete = F.lit(True)
    for c in model.cols:
        complete = complete & F.col(c).isNotNull()
    scored = df.withColumn("_x", F.when(complete, model.scaled())).withColumn("_y", model.reconstructed(F.col("_x")))
    total = lambda terms: F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x) / n
    gap = F.zip_with("_x", "_y", lambda x, y: x - y)
    logs = F.lit(0.0)
    for i, c in enumerate(model.cols):
        stats = model.scaler.stats[c]
        back = F.get("_y", F.lit(i)) * F.lit(float(stats["std"] or 0.0)) + F.lit(float(stats["mean"]))
        difference = F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) - F.log1p(F.greatest(back, F.lit(0.0)))
        logs = logs + difference * difference
    return scored.withColumns({
        "mean_absolute_error": total(F.transform(gap, lambda e: F.abs(e))),
        "mean_squared_error": total(F.transform(gap, lambda e: e * e)),
        "mean_squared_log_error": F.when(F.col("_y").isNotNull(), logs / n),
    }).drop("_x", "_y")


def fit_contamination(scored: DataFrame, score: str, contamination: float) -> float | None:
    """The exact (1 - contamination) quantile of a score."""
    if not 0 < contamination < 1:
        raise ValueError("contamination lies between 0 and 1")
    row = quantile_exact(scored, score, [1.0 - contamination]).first()
    return None if row is None else row["value"]


def flag_by_contamination(scored: DataFrame, score: str, contamination: float) -> DataFrame:
    """Flags the share of rows with the highest score."""
    return flag_rows(scored, F.col(score) > F.lit(fit_contamination(scored, score, contamination)))


def fit_threshold(model: AutoencoderModel, train: DataFrame, contamination: float) -> float:
    """Stores with the model the error that the given share of the training rows exceeds."""
    # The network runs once per row; the passes of the quantile read the stored errors.
    errors = store(reconstruction_loss(model, train).select("mean_squared_error"), "errors")
    model.thresholds[str(contamination)] = fit_contamination(errors, "mean_squared_error", contamination)
    return model.thresholds[str(contamination)]


def detect_anomalies(model: AutoencoderModel, df: DataFrame, contamination: float) -> DataFrame:
    """All rows with ``mean_squared_error`` and ``is_anomaly``.

    The threshold that ``fit_threshold`` stored with the model is used; for a model without one it is taken from
    these rows, for this call only.
    """
    scored = reconstruction_loss(model, df).drop("mean_absolute_error", "mean_squared_log_error")
    cut = model.thresholds.get(str(contamination))
    if cut is None:
        scored = store(scored, "scored")
        cut = fit_contamination(scored, "mean_squared_error", contamination)
    return flag_rows(scored, F.col("mean_squared_error") > F.lit(cut))


def detect_by_sigma(df: DataFrame, score: str, k: int) -> DataFrame:
    """Flags rows whose score exceeds the mean by more than k standard deviations."""
    cut = sigma_thresholds(df, score, [k]).select("threshold").scalar()
    return flag_rows(df, F.col(score) > cut)


def evaluate(model: AutoencoderModel | TreeModel, df: DataFrame) -> DataFrame:
    """One row of metrics of a model on the given rows."""
    if isinstance(model, (TreeModel, BoostedModel)):
        return regression_metrics(predict(model, df), model.label, f"predicted_{model.label}")
    errors = reconstruction_loss(model, df).agg(*[F.avg(e).alias(e) for e in ERRORS])
    return errors.withColumn("root_mean_squared_error", F.sqrt("mean_squared_error"))


def metric_rows(metrics: DataFrame, model: str) -> DataFrame:
    """A one-row metric table as (model, metric, value) rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics.columns]
    return metrics.select(F.lit(model).alias("model"), F.inline(F.array(*pairs)))


def compare_models(metrics: DataFrame, metric: str, threshold: float, higher_is_better: bool = False) -> DataFrame:
    """One row: the best model by a metric and whether it passes the threshold.

    ``metrics`` holds (model, metric, value); equal values are decided by model name.
    """
    rows = metrics.filter((F.col("metric") == metric) & F.col("value").isNotNull())
    sign = -1.0 if higher_is_better else 1.0
    best = rows.agg(F.min(F.struct((F.col("value") * sign).alias("cost"), F.col("model"))).alias("best"))
    value = F.col("best.cost") * sign
    passes = value > threshold if higher_is_better else value < threshold
    return best.select(
        F.col("best.model").alias("best_model"), F.lit(metric).alias("metric"), value.alias("value"),
        F.coalesce(passes, F.lit(False)).alias("deploy"),
    )


def validate_scored_rows(model: AutoencoderModel | TreeModel, rows: DataFrame) -> DataFrame:
    """Scores probe rows; ValueError unless every row gets a finite result."""
    if isinstance(model, (TreeModel, BoostedModel)):
        scored, score = predict(model, rows), f"predicted_{model.label}"
    else:
        scored, score = reconstruction_loss(model, rows), "mean_squared_error"
    finite = F.col(score).isNotNull() & ~F.isnan(score) & (F.abs(score) < float("inf"))
    bad = scored.filter(~F.coalesce(finite, F.lit(False))).count()
    if bad:
        raise ValueError(f"{bad} probe rows have no finite {score}")
    return scored


def anomaly_agreement(
    pred: DataFrame, actual: DataFrame, on: Sequence[str], flag: str = "is_anomaly"
) -> DataFrame:
    """(predicted, actual, rows): how often both flags meet when joined by key.

    Both sides are counted per key and flag first; a key that repeats m times on one side and n on
    the other adds m * n without those pairs being formed.
    """
    count = F.count(F.lit(1))
    p = pred.groupBy(*on, F.col(flag).alias("predicted")).agg(count.alias("_np"))
    a = actual.groupBy(*on, F.col(flag).alias("actual")).agg(count.alias("_na"))
    pairs = a.join(p, list(on))
    return pairs.groupBy("predicted", "actual").agg(F.sum(F.col("_np") * F.col("_na")).alias("rows"))


def agreeing_rows(pred: DataFrame, actual: DataFrame, on: Iterable[str], flag: str = "is_anomaly") -> DataFrame:
    """Where both flags are the same: (keys, predicted, actual, rows).

    ``rows`` is how often the joined row would repeat; repeats are counted, not formed.
    """
    on, count = list(on), F.count(F.lit(1))
    p = pred.groupBy(*on, F.col(flag).alias("predicted")).agg(count.alias("_np"))
    a = actual.groupBy(*on, F.col(flag).alias("actual")).agg(count.alias("_na"))
    same = a.join(p, on, "left").filter(F.col("predicted") == F.col("actual"))
    return same.select(*on, "predicted", "actual", (F.col("_np") * F.col("_na")).alias("rows"))
