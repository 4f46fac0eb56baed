"""Writers for CSV, tables, JSON lines and models, and the update-from-source step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Create or replace a parquet table from a frame and return it."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def export_csv(spark: SparkSession, table: str, path: str) -> None:
    write_csv(spark.table(table), path)


#: Rows of a compressed file, which a reader cannot part.
COMPRESSED_ROWS = 1_000_000


def write_jsonl(
    df: DataFrame, path: str, n: int | None = None, order_by: Sequence[str] | None = None, compression: str | None = None
) -> None:
    """Rows as JSON lines; the first ``n`` by ``order_by`` when given. ``compression`` is a codec of Spark's, such as ``gzip``."""
    if n is not None:
        if not order_by:
            raise ValueError("the first n rows need order_by")
        df = df.orderBy(*order_by).limit(n)
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", COMPRESSED_ROWS)
    writer.json(path)


def update_from(target: DataFrame, source: DataFrame, on: Sequence[str], set_cols: Sequence[str]) -> DataFrame:
    """The target with ``set_cols`` taken from the matching source row; other rows keep their value.

    Source keys must be unique, as in an UPDATE ... FROM; of several rows per key the largest wins.
    """
    new = F.struct(*[F.col(c) for c in set_cols])
    latest = source.groupBy(*on).agg(F.max(new).alias("_new"))
    joined = target.join(latest, list(on), "left")
    kept = []
    for name in target.columns:
        if name in set_cols:
            kept.append(F.when(F.col("_new").isNotNull(), F.col("_new")[name]).otherwise(F.col(name)).alias(name))
        else:
            kept.append(F.col(name))
    return joined.select(*kept)


def save_model(model, path: str) -> None:
    """Store a model with its transform. Own models bring ``save``; Spark ML models their writer."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_model(path: str, kind=None, spark: SparkSession | None = None):
    """Load a model saved by ``save_model``; ``kind`` names the class when it is not a Spark pipeline."""
    if kind is None:
        return PipelineModel.load(path)
    return kind.load(path) if spark is None else kind.load(spark, path)
