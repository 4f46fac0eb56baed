"""The serving table: many batches, folds while the stream runs, and what is broken off in between."""

import random

import pytest
from helpers import rows

from ringspan.streaming import compact, fold, latest_rows, sync, sync_latest, vacuum

SCHEMA = "key int, t int, v string"


def feed(spark, folder, batches):
    """One file per batch, in this order."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/b{i:03d}")


def run(spark, source, table, state, **more):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    sync_latest(stream, "key", "t", table, state, **more).awaitTermination()


def best(batches):
    found = {}
    for k, t, v in (r for b in batches for r in b):
        if k not in found or t > found[k][1]:
            found[k] = (k, t, v)
    return sorted(found.values())


def made(n, seed=1, keys=40):
    rng = random.Random(seed)
    times = iter(rng.sample(range(10_000), n * 6))
    return [[(rng.randrange(keys), next(times), f"{b}-{i}") for i in range(6)] for b in range(n)]


def test_fifty_batches(spark, tmp_path):
    batches, at = made(50), str(tmp_path)
    feed(spark, f"{at}/src", batches)
    run(spark, f"{at}/src", f"{at}/table", f"{at}/state", fanout=8)
    log = sync.Log(spark, f"{at}/table")
    entries = log.read().entries
    assert sum(e["batch"] for e in entries) == 50 % 8 and 1 <= sum(not e["batch"] for e in entries) <= 2
    assert rows(latest_rows(spark, f"{at}/table", "key", "t")) == best(batches)
    level = next(e["folder"] for e in entries if not e["batch"])
    keys = [r["key"] for r in spark.read.parquet(f"{at}/table/{level}").collect()]
    assert len(keys) == len(set(keys))
    old = log.versions()[-3]
    assert latest_rows(spark, f"{at}/table", "key", "t", version=old).count() > 0
    gone = vacuum(spark, f"{at}/table", min_age=0)
    assert len(gone) > 40 and rows(latest_rows(spark, f"{at}/table", "key", "t")) == best(batches)
    assert vacuum(spark, f"{at}/table", min_age=0) == [] and log.versions()[-1] == 56
    assert rows(compact(spark, f"{at}/table", "key", "t")) == best(batches) and len(log.read().entries) == 1


@pytest.mark.parametrize("broken", ["before the batch", "after the batch", "before the fold"])
def test_broken_off_anywhere(spark, tmp_path, monkeypatch, broken):
    """The stream fails at its sixth batch, which folds; the restart loses nothing and repeats nothing."""
    batches, at = made(9, seed=4), str(tmp_path)
    feed(spark, f"{at}/src", batches)
    commit, calls = sync.Log.commit, []

    def failing(self, change):
        calls.append(1)
        # Batches 0 to 5 with a fold after each third one: commits 1 2 3 fold 5 6 7 fold.
        if broken == "before the batch" and len(calls) == 7 or broken == "before the fold" and len(calls) == 8:
            raise RuntimeError("lost")
        done = commit(self, change)
        if broken == "after the batch" and len(calls) == 7:
            raise RuntimeError("lost")
        return done

    monkeypatch.setattr(sync.Log, "commit", failing)
    with pytest.raises(Exception, match="lost"):
        run(spark, f"{at}/src", f"{at}/table", f"{at}/state", fanout=3)
    monkeypatch.setattr(sync.Log, "commit", commit)
    run(spark, f"{at}/src", f"{at}/table", f"{at}/state", fanout=3)
    manifest = sync.Log(spark, f"{at}/table").read()
    assert list(manifest.done.values()) == [8] and not any(e["batch"] for e in manifest.entries)
    assert rows(latest_rows(spark, f"{at}/table", "key", "t")) == best(batches)


def test_two_writers_and_a_fold_that_comes_second(spark, tmp_path, monkeypatch):
    batches, at = made(4, seed=9), str(tmp_path)
    feed(spark, f"{at}/one", batches[:2])
    feed(spark, f"{at}/two", batches[2:])
    for name in ("one", "two"):
        run(spark, f"{at}/{name}", f"{at}/table", f"{at}/state-{name}")
    assert rows(latest_rows(spark, f"{at}/table", "key", "t")) == best(batches)
    log, real, raced = sync.Log(spark, f"{at}/table"), sync.Log._renamed, []

    def slower(self, source, target):
        if not raced:  # another fold commits first
            raced.append(1)
            assert fold(spark, f"{at}/table", "key", "t", fanout=2)
        return real(self, source, target)

    monkeypatch.setattr(sync.Log, "_renamed", slower)
    assert not fold(spark, f"{at}/table", "key", "t", fanout=2)
    assert len(log.read().entries) == 1
    assert rows(latest_rows(spark, f"{at}/table", "key", "t")) == best(batches)


def test_odd_tables(spark, tmp_path):
    at = str(tmp_path)
    with pytest.raises(ValueError, match="nothing was committed"):
        latest_rows(spark, f"{at}/none", "key", "t")
    assert vacuum(spark, f"{at}/none") == [] and not fold(spark, f"{at}/none", "key", "t")
    feed(spark, f"{at}/src", [[(None, 1, "a"), (None, 2, None), (3, None, "c")]])
    run(spark, f"{at}/src", f"{at}/table", f"{at}/state")
    assert rows(latest_rows(spark, f"{at}/table", "key", "t")) == [(3, None, "c"), (None, 2, None)]
    moved = compact(spark, f"{at}/table", "key", "t", f"{at}/new")
    assert rows(moved) == [(3, None, "c"), (None, 2, None)]
    with pytest.raises(ValueError, match="holds a table"):
        compact(spark, f"{at}/table", "key", "t", f"{at}/new")
