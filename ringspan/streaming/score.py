"""Scoring rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.anomaly import reconstruction_loss
from ..operators.autoencoder import AutoencoderModel
from ..operators.boosting import BoostedModel
from ..operators.columns import flag_rows
from ..operators.trees import TreeModel, predict


def score_stream(stream: DataFrame, model: TreeModel | BoostedModel | AutoencoderModel, contamination: float | None = None) -> DataFrame:
    """The streaming frame with the model's output; the fitted transform goes with the model, nothing is kept.

    An autoencoder needs a threshold fitted beforehand to flag rows; without ``contamination`` rows
    only get their reconstruction errors.
    """
    if isinstance(model, (TreeModel, BoostedModel)):
        return predict(model, stream)
    scored = reconstruction_loss(model, stream)
    if contamination is None:
        return scored
    if str(contamination) not in model.thresholds:
        raise ValueError("fit the threshold on training rows before scoring a stream")
    return flag_rows(scored, scored["mean_squared_error"] > model.thresholds[str(contamination)])


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs everything available into parquet files at ``path``, exactly once per input row."""
    run = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    run.trigger(availableNow=True).start().awaitTermination()
