"""Keeping a serving table at the latest row per key.

The table is a set of parquet folders and a log of small manifests that name the live ones. A manifest is written
aside and renamed to the next number, so a reader sees a batch or a fold whole or not at all, and a restart finds what
was committed. Batches are folded into levels sorted by key, each several times larger than the one before, while the
stream runs: a read touches one folder per level and the batches since the last fold.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import partitions_for

#: Batches that are folded together, and how many times larger than them a level may be to be folded in as well.
FANOUT = 8


@dataclass
class Manifest:
    """The live folders of a table, oldest first, and the last batch that every streaming query has committed."""

    version: int = 0
    entries: list[dict] = field(default_factory=list)  # folder, rows, batch (not yet folded)
    done: dict[str, int] = field(default_factory=dict)

    def folders(self) -> list[str]:
        return [e["folder"] for e in self.entries]


class Log:
    """The manifests of a serving table, on any file system Spark reaches whose rename refuses an existing name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        folder = self._at("_log")
        names = [s.getPath().getName() for s in self._files.listStatus(folder)] if self._files.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, version: int | None = None) -> Manifest:
        """A manifest by number, by default the newest; an empty one if there is none."""
        known = self.versions()
        if not known:
            return Manifest()
        version = known[-1] if version is None else version
        source = self._files.open(self._at(f"_log/{version:012d}.json"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()
        return Manifest(version, found["entries"], found["done"])

    def commit(self, change: Callable[[Manifest], Manifest | None]) -> bool:
        """Make ``change`` of the newest manifest the next one; False if it gives None.

        Whoever renames first has the number; the other reads the newer manifest and tries again.
        """
        while True:
            now = self.read()
            then = change(now)
            if then is None:
                return False
            aside = self._at(f"_log/.{uuid.uuid4().hex}")
            sink = self._files.create(aside)
            sink.write(json.dumps({"entries": then.entries, "done": then.done}).encode())
            sink.close()
            if self._renamed(aside, self._at(f"_log/{now.version + 1:012d}.json")):
                return True
            self._files.delete(aside, False)

    def _renamed(self, source, target) -> bool:
        context = self._fs.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        try:
            context.rename(self._files.makeQualified(source), self._files.makeQualified(target), options)
        except Exception as refused:
            if "FileAlreadyExistsException" in str(refused):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)

    def ages(self) -> dict[str, float]:
        """Seconds since each folder of rows was last changed."""
        if not self._files.exists(self._at("")):
            return {}
        found = {s.getPath().getName(): s.getModificationTime() for s in self._files.listStatus(self._at(""))}
        return {n: time.time() - t / 1000 for n, t in found.items() if n != "_log"}


def newest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` of every key; combined before the shuffle, so a busy key is one row per task."""
    rest = [c for c in df.columns if c not in key]
    ranked = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order]))
    names = [F.col(f"`{c}`") for c in key]
    return df.groupBy(*names).agg(ranked.alias("_row")).select(*names, "_row.*").select(*[f"`{c}`" for c in df.columns])


def _rows(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path.rstrip('/')}/{f}" for f in folders])


def _folded(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest rows in files of increasing keys, so that a filter on the key reads few of them."""
    columns = [F.col(f"`{c}`") for c in key]
    return newest(rows, key, order).repartitionByRange(partitions_for(rows), *columns).sortWithinPartitions(*columns)


def sync_latest(
    stream: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str, path: str, checkpoint: str, fanout: int = FANOUT
) -> StreamingQuery:
    """Starts copying a stream into a serving table keyed by entity, with all that is available.

    Each batch writes its newest rows per key to a folder of its own and commits it; a batch that the manifest already
    holds is passed over, and one that was written but not committed is written again. After ``fanout`` batches they
    are folded with every level that is at most ``fanout`` times as large, so a row is rewritten once per level.
    Several queries, also ones that lost their checkpoint, may write to one table. ``latest_rows`` reads it.
    """
    key, order = _list(key), _list(order)
    run_of: dict[str, str] = {}

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # The id is kept in the checkpoint, so a restart with it goes on under the same name.
        run = run_of.setdefault("id", _run_id(spark, checkpoint))
        log = Log(spark, path)
        if log.read().done.get(run, -1) < number:
            folder = f"run={run}-batch={number}"
            newest(batch, key, order).write.mode("overwrite").parquet(f"{log.path}/{folder}")
            entry = {"folder": folder, "rows": _rows(spark, path, [folder]).count(), "batch": True}
            log.commit(lambda m: Manifest(m.version, [*m.entries, entry], {**m.done, run: number}))
        fold(spark, path, key, order, fanout)

    run = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run.trigger(availableNow=True).start()


def fold(spark: SparkSession, path: str, key: Sequence[str] | str, order: Sequence[str] | str, fanout: int = FANOUT) -> bool:
    """Fold the batches of a table into a sorted level if there are ``fanout`` of them; whether it did.

    The new level is committed in place of its parts in one manifest, and only if all of them are still live, so a fold
    that is broken off, or comes second, changes nothing.
    """
    log = Log(spark, path)
    entries = log.read().entries
    parts = [e for e in entries if e["batch"]]
    if len(parts) < fanout:
        return False
    levels = [e for e in entries if not e["batch"]]
    while levels and levels[-1]["rows"] <= fanout * sum(e["rows"] for e in parts):
        parts.insert(0, levels.pop())
    return _replace(log, [e["folder"] for e in parts], _list(key), _list(order))


def _replace(log: Log, parts: list[str], key: Sequence[str], order: Sequence[str]) -> bool:
    folder = f"level-{uuid.uuid4().hex}"
    _folded(_rows(log.spark, log.path, parts), key, order).write.parquet(f"{log.path}/{folder}")
    entry = {"folder": folder, "rows": _rows(log.spark, log.path, [folder]).count(), "batch": False}

    def change(m: Manifest) -> Manifest | None:
        if not set(parts) <= set(m.folders()):
            return None
        rest = [e for e in m.entries if e["folder"] not in parts]
        levels = [e for e in rest if not e["batch"]]
        return Manifest(m.version, [*levels, entry, *[e for e in rest if e["batch"]]], m.done)

    return log.commit(change)


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns a checkpoint."""
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def latest_rows(
    spark: SparkSession, path: str, key: Sequence[str] | str, order: Sequence[str] | str, version: int | None = None
) -> DataFrame:
    """The serving table: one row per key, of the newest manifest or of an older one that ``vacuum`` has left."""
    folders = Log(spark, path).read(version).folders()
    if not folders:
        raise ValueError(f"nothing was committed to {path}")
    return newest(_rows(spark, path, folders), _list(key), _list(order))


def compact(spark: SparkSession, path: str, key: Sequence[str] | str, order: Sequence[str] | str, target: str | None = None) -> DataFrame:
    """Fold the whole table into one sorted level, in place or as a new table at ``target``, to be read and synced to."""
    log = Log(spark, path)
    if target is None:
        _replace(log, log.read().folders(), _list(key), _list(order))
        return latest_rows(spark, path, key, order)
    new = Log(spark, target)
    if new.versions():
        raise ValueError(f"{target} holds a table")
    folder = f"level-{uuid.uuid4().hex}"
    _folded(_rows(spark, path, log.read().folders()), _list(key), _list(order)).write.parquet(f"{new.path}/{folder}")
    entry = {"folder": folder, "rows": _rows(spark, target, [folder]).count(), "batch": False}
    new.commit(lambda m: None if m.entries else Manifest(m.version, [entry], {}))
    return latest_rows(spark, target, key, order)


def vacuum(spark: SparkSession, path: str, keep: int = 2, min_age: float = 86_400.0) -> list[str]:
    """Delete the folders that none of the last ``keep`` manifests names and nothing has changed for ``min_age`` seconds.

    Younger ones may be those of a batch or a fold about to be committed. Older manifests go too.
    """
    log = Log(spark, path)
    versions = log.versions()
    live = {f for v in versions[-keep:] for f in log.read(v).folders()}
    gone = sorted(n for n, age in log.ages().items() if n not in live and age >= min_age)
    for name in gone:
        log.delete(name)
    for version in versions[:-keep]:
        log.delete(f"_log/{version:012d}.json")
    return gone


def _list(names: Sequence[str] | str) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
