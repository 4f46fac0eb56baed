"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ringspan", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and no web page; ``conf`` adds settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # local-cluster has executors of its own, which do not share a folder made here.
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="ringspan-")
    context.setCheckpointDir(base)
    return base


#: Scratch paths given out and not yet released.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; ``scratch`` or ``release`` removes what is written there."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch paths given out from the ``since``-th on. Frames that read them end there."""
    for path in _scratch[since:]:
        discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch path given out."""
    _scratch.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession, keep: tuple[str, ...] = ()) -> Iterator[None]:
    """Stored rows and models made inside are deleted at the end, so write the results elsewhere before it.

    What was stored under a name in ``keep`` stays.
    """
    since = len(_scratch)
    try:
        yield
    finally:
        for path in _scratch[since:]:
            if os.path.basename(path).rpartition("-")[0] not in keep:
                discard(spark, path)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's shuffle files go when it ends, and not only when the driver happens to collect its garbage.

    Frames made inside are for one action each; ``store`` is one.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def store(df: DataFrame, name: str = "rows") -> DataFrame:
    """The rows as a parquet table in the shared folder: computed once, then read column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def size_of(df: DataFrame) -> int:
    """The optimizer's size of ``df`` in bytes; 0 where it knows none."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 if size >= 1 << 60 else size


def partitions_for(df: DataFrame, target_bytes: int = 128 << 20) -> int:
    """Partitions that hold about ``target_bytes`` each by the optimizer's size of ``df``, and no fewer than the setting.

    The setting alone does not follow the data; frames of unknown size take it.
    """
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(setting, -(-size_of(df) // target_bytes))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive lost executors and are not recomputed."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
