"""Helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Row numbers or ids (some tens of bytes each as a hash table) up to which they are broadcast to the rows they concern.
BROADCAST_IDS = 4_000_000
#: White space between words, and its complement.
SPACE = r"[\x20\x09-\x0D]"


def partitions_for(df: DataFrame, target_bytes: int = 64 << 20) -> int:
    """As many partitions as give each about ``target_bytes`` by the optimizer's size of ``df``; 12 at least.

    Follows the data, unlike ``spark.sql.shuffle.partitions``. Frames of unknown size take that setting.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size >= 1 << 60:
        return setting
    return max(12, min(setting, 200), -(-size // target_bytes))


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def text_column(name: str = "text"):
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def ascii_lower(column):
    """A-Z in lower case and nothing else changed."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def few_ids(ids: DataFrame) -> DataFrame:
    """Stored ids with a broadcast hint if they are at most ``BROADCAST_IDS``, so that the texts they concern stay where
    they are; more go through the planner."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def arrow_schema(**fields: str) -> tuple[pa.Schema, str]:
    """An Arrow schema and the same as Spark's text form."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
        "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(k, kinds[v]) for k, v in fields.items()]), ", ".join(f"`{k}` {v}" for k, v in fields.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
