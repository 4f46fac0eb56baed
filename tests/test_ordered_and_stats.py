"""Numbering, running sums, top-k, quantiles and statistics, also on their paths for large data."""

import os
from collections import Counter

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringspan import functions as S
from ringspan.operators import aggregates as A
from ringspan.operators import features as X
from ringspan.operators import joins as J
from ringspan.operators import ordered as O
from ringspan.operators import ranges as R
from ringspan.session import scratch, store


@pytest.fixture(autouse=True)
def short_ranges(monkeypatch):
    """Ranges of few rows, so that small tables have several."""
    monkeypatch.setattr(R, "ROWS_PER_RANGE", 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, ties included."""
    rng = np.random.default_rng(5)
    data = [(i, "hot" if i % 3 == 0 else f"k{i % 7}", int(rng.integers(0, 40)), float(rng.normal())) for i in range(3000)]
    return spark.createDataFrame(data, "id int, key string, pos int, x double").repartition(6)


def test_row_number_covers_everything(skewed):
    numbered = O.row_number(skewed, ["pos", "id"], "n")
    found = [(r["pos"], r["id"]) for r in numbered.orderBy("n").collect()]
    assert found == sorted(found) and len(found) == 3000
    per_key = O.row_number(skewed, ["pos", "id"], "n", by=["key"])
    for r in per_key.groupBy("key").agg(F.max("n").alias("m"), F.countDistinct("n").alias("d"), F.count("n").alias("c")).collect():
        assert r["m"] == r["d"] == r["c"]


def test_no_window_holds_all_rows(skewed):
    plan = O.row_number(skewed, ["pos", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def exchanges(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange " in line for line in plan.splitlines())


def test_rows_move_once(skewed):
    own = exchanges(skewed)
    assert exchanges(O.row_number(skewed, ["pos", "id"])) == own + 1
    assert exchanges(O.row_number(skewed, ["pos", "id"], by=["key"])) == own + 1
    assert exchanges(O.running_sum(skewed, "x", "pos", by=["key"])) == own + 1
    assert exchanges(O.top_k_per_group(skewed, "key", ["x"], 3)) == own + 1
    assert exchanges(O.top_k_per_group(skewed, "key", ["x"], 1500)) == own + 1


ODD_KEYS = """
    id int, i int, l bigint, d double, t string, b boolean, day date, at timestamp, plain timestamp_ntz, price decimal(12,2), raw binary
"""


@pytest.fixture(scope="module")
def odd_keys(spark):
    import datetime as dt
    from decimal import Decimal

    data = []
    for i in range(240):
        at = dt.datetime(1960 + i % 90, 1 + i % 12, 1 + i % 28, i % 24, 0, 0, i * 1001)
        data.append((
            i, i % 7 - 3, -(1 << 63) if i % 50 == 0 else i * 31 % 11, [float("nan"), float("inf"), -0.0, i / 7 - 9.0, -1e300][i % 5],
            ["", "a", "ab", "b\u00e9", "\U0001f600", "Z" * (i % 4)][i % 6], i % 2 == 0, at.date(), at, at, Decimal(i * 7 % 100) / 4 - 9, bytes([i % 200, 0][: i % 3]),
        ))
    data += [(240 + j, *[None] * 10) for j in range(9)]
    return spark.createDataFrame(data, ODD_KEYS).repartition(5)


WAYS = [(c, F.desc) for c in ("i", "l", "d", "t", "b", "day", "at", "plain", "price", "raw")]


@pytest.mark.parametrize("column, way", [*WAYS, ("d", F.asc), ("t", F.asc), ("i", F.asc_nulls_last), ("t", F.desc_nulls_first)])
def test_ranges_of_every_type_follow_sparks_order(odd_keys, column, way):
    found = [(r["n"], r["id"]) for r in O.row_number(odd_keys, [way(column), "id"], "n").select("n", "id").collect()]
    assert [i for _, i in sorted(found)] == [r["id"] for r in odd_keys.orderBy(way(column), "id").select("id").collect()]
    assert sorted(n for n, _ in found) == list(range(1, 250))


def test_running_sum_of_one_hot_tie(spark):
    """Most rows tie on one key: their total is known beforehand, and they are dealt over several tasks."""
    df = spark.createDataFrame([(i, 5 if i % 4 else i // 40, 1) for i in range(2000)], "id int, k int, v int").repartition(4)
    found = {(r["k"], r["running_sum"]) for r in O.running_sum(df, "v", "k").collect()}
    counts = Counter(5 if i % 4 else i // 40 for i in range(2000))
    assert found == {(k, sum(n for j, n in counts.items() if j <= k)) for k in counts}


def test_prefix_columns_do_not_clash(spark):
    df = spark.createDataFrame([(3, 1), (1, 2), (2, 3)], "_rplace int, _range int")
    found = O.row_number(df, ["_rplace"], "n")
    assert found.columns == ["_rplace", "_range", "n"] and rows(found) == [(1, 2, 1), (2, 3, 2), (3, 1, 3)]
    assert O.row_number(df.limit(0), ["_rplace"], "n").count() == 0


def test_running_sum_shares_ties(spark):
    df = spark.createDataFrame([(1, 10), (1, 5), (2, 1), (3, None), (4, 2)], "k int, v int")
    assert rows(O.running_sum(df, "v", "k").select("k", "running_sum")) == [(1, 15), (1, 15), (2, 16), (3, 16), (4, 18)]


def test_running_sum_with_null_group(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), ("a", 1, 5)], "g string, k int, v int")
    found = {(r["g"], r["k"]): r["running_sum"] for r in O.running_sum(df, "v", "k", by=["g"]).collect()}
    assert found == {(None, 1): 1, (None, 2): 3, ("a", 1): 5}


@pytest.mark.parametrize("k", [3, 1000])
def test_top_k(skewed, k):
    found = O.top_k_per_group(skewed, "key", [F.desc("x"), "id"], k).select("key", "id")
    expected = skewed.toPandas().sort_values(["x", "id"], ascending=[False, True]).groupby("key").head(k)
    assert set(map(tuple, rows(found))) == set(zip(expected["key"], expected["id"].astype(int)))


def test_small_k_is_limited_before_the_shuffle(skewed):
    plan = O.top_k_per_group(skewed, "key", ["x"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_samples_do_not_depend_on_partitions(skewed):
    one = rows(O.sample_per_group(skewed, "key", 5, "id", 1).select("id"))
    assert rows(O.sample_per_group(skewed.repartition(3), "key", 5, "id", 1).select("id")) == one
    assert rows(O.sample_n(skewed, 10, "id", 1)) == rows(O.sample_n(skewed.coalesce(1), 10, "id", 1))
    train, test = O.train_test_split(skewed, 0.8, "id", 3)
    assert train.count() + test.count() == 3000 and 0.75 < train.count() / 3000 < 0.85
    assert train.join(test, "id").count() == 0


@pytest.mark.parametrize("limit, accuracy", [(1_000_000, 10_000), (0, 10_000), (500, 100), (0, 20)])
def test_exact_quantiles_on_every_path(skewed, monkeypatch, limit, accuracy):
    """Direct ranks, range-partitioned ranks, and brackets of different widths."""
    monkeypatch.setattr(A, "DISTINCT_ROWS", limit)
    monkeypatch.setattr(A, "SKETCH_ACCURACY", accuracy)
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    found = {(r["column"], r["prob"]): r["value"] for r in A.quantile_exact(skewed, ["x", "pos"], probs).collect()}
    frame = skewed.toPandas()
    for c in ("x", "pos"):
        for p in probs:
            assert found[c, p] == pytest.approx(np.quantile(frame[c], p), abs=1e-12)
    monkeypatch.setattr(A, "GROUP_ACCURACY", accuracy)
    by_key = {(r["key"], r["column"], r["prob"]): r["value"] for r in A.quantile_exact(skewed, ["x", "pos"], probs, by=["key"]).collect()}
    assert len(by_key) == 2 * len(probs) * frame["key"].nunique()
    for key, part in frame.groupby("key"):
        for c in ("x", "pos"):
            for p in probs:
                assert by_key[key, c, p] == pytest.approx(np.quantile(part[c], p), abs=1e-12)


def test_exact_quantiles_of_odd_columns(spark, monkeypatch):
    monkeypatch.setattr(A, "DISTINCT_ROWS", 0)
    df = spark.createDataFrame([(1.0, None, float("nan")), (2.0, None, 1.0), (2.0, None, 3.0)], "a double, b double, c double")
    found = {(r["column"], r["prob"]): r["value"] for r in A.quantile_exact(df, ["a", "b", "c"], [0.0, 0.5, 1.0]).collect()}
    assert ("b", 0.5) not in found and found["a", 0.5] == 2.0 and found["a", 0.0] == 1.0
    assert found["c", 0.5] == 3.0 and np.isnan(found["c", 1.0])


def test_only_bracketed_values_of_groups_move(spark, monkeypatch):
    """Many small groups and a hot one, NULL groups and values, NaN: the values stored for ranking are few."""
    monkeypatch.setattr(A, "DISTINCT_ROWS", 0)
    kept, real = [], A.store
    monkeypatch.setattr(A, "store", lambda df, name="rows": kept.append((name, real(df, name))) or kept[-1][1])
    rng = np.random.default_rng(8)
    data = [("hot" if i % 3 == 0 else f"g{i % 40}" if i % 11 else None, float(v), None if i % 5 else float(i)) for i, v in enumerate(rng.normal(size=30_000))]
    data += [("odd", float("nan"), None), ("odd", 1.0, None), ("odd", 2.0, None), ("bare", None, None)]
    df = spark.createDataFrame(data, "g string, x double, y double").repartition(4)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = {(r["g"], r["column"], r["prob"]): r["value"] for r in A.quantile_exact(df, ["x", "y"], probs, by=["g"]).collect()}
    frame = df.toPandas()
    for g in frame["g"].unique():
        part = frame[frame["g"].isna() if g is None else frame["g"] == g]
        for c in ("x", "y"):
            values = np.sort(part[c].to_numpy()) if g == "odd" else part[c].dropna().to_numpy()
            for p in probs:
                if g == "odd" and c == "x":
                    want = [1.0, 1.5, 2.0, float("nan"), float("nan")][probs.index(p)]
                    assert found[g, c, p] == want or np.isnan(want) and np.isnan(found[g, c, p])
                elif len(values) and not np.isnan(values).all():
                    assert found[g, c, p] == pytest.approx(np.quantile(values, p), abs=1e-12)
                else:
                    assert (g, c, p) not in found
    moved = next(f for n, f in kept if n == "bracket-values")
    assert moved.filter("g = 'hot'").agg(F.sum("n")).first()[0] < 0.1 * len(frame)


def test_approx_quantile_rank_error(skewed):
    frame = skewed.toPandas()
    for r in A.quantile_approx(skewed, "x", [0.2, 0.5, 0.9], err=0.01).collect():
        assert abs((frame["x"] <= r["value"]).mean() - r["prob"]) <= 0.011


def test_describe_edges(spark):
    df = spark.createDataFrame([(1.0, None, 7.0), (2.0, None, 7.0)], "a double, b double, c double")
    found = {r["column"]: r for r in A.describe(df, ["a", "b", "c"]).collect()}
    assert found["b"]["count"] == 0 and found["b"]["q50"] is None
    assert found["c"]["std"] == 0.0 and found["a"]["q50"] == 1.5
    empty = {r["column"]: r for r in A.describe(df.limit(0), ["a"]).collect()}
    assert empty["a"]["count"] == 0
    single = A.describe(df.limit(1), ["a"]).first()
    assert single["std"] is None and single["q25"] == 1.0


def test_string_agg_chunks_are_whole_and_bounded(spark):
    df = spark.createDataFrame([(i, "w" * (i % 9 + 1)) for i in range(500)], "id int, t string")
    chunks = A.string_agg(df, F.col("t"), ",", ["id"], max_chars=100).orderBy("chunk").collect()
    assert ",".join(c["text"] for c in chunks) == ",".join("w" * (i % 9 + 1) for i in range(500))
    assert len(chunks) > 10 and max(len(c["text"]) for c in chunks) <= 110


def test_sigma_confidence(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "s double")
    found = {r["k"]: r for r in A.sigma_thresholds(df, "s").collect()}
    assert found[1]["threshold"] == 3.0 and found[2]["confidence"] == pytest.approx(95.4499736)


def test_metrics_against_numpy(skewed):
    df = skewed.withColumn("p", F.col("pos") + F.col("x"))
    row, frame = A.regression_metrics(df, "pos", "p").first(), df.toPandas()
    assert row["mean_squared_error"] == pytest.approx(((frame["pos"] - frame["p"]) ** 2).mean())
    assert row["r2_score"] == pytest.approx(1 - ((frame["pos"] - frame["p"]) ** 2).sum() / ((frame["pos"] - frame["pos"].mean()) ** 2).sum())


def test_confusion_ignores_unknown(spark):
    df = spark.createDataFrame([(True, True), (False, True), (None, True), (True, None)], "a boolean, p boolean")
    row = A.label_confusion(df, "a", "p").first()
    assert (row["true_positive"], row["false_positive"], row["false_negative"], row["true_negative"]) == (1, 1, 0, 0)
    assert row["precision"] == 0.5 and row["recall"] == 1.0


def test_cross_join_is_a_generator_for_small_sides_only(spark, skewed):
    small = spark.createDataFrame([(1,), (2,)], "r int")
    product = J.cross_join(skewed, small)
    plan = product._jdf.queryExecution().executedPlan().toString()
    assert product.count() == 6000 and "NestedLoop" not in plan and "Cartesian" not in plan
    assert J.cross_join(small, spark.range(J.SMALL_ROWS + 1)).count() == 2 * (J.SMALL_ROWS + 1)
    wide = spark.createDataFrame([("x" * 4_000_000,)] * 3, "t string")
    assert "Generate" not in J.cross_join(small, wide)._jdf.queryExecution().executedPlan().toString()


def test_wide_small_tables_are_not_broadcast(spark):
    dim = spark.range(40).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1_000_000).alias("name"))
    facts = spark.range(100).select((F.col("id") % 40).alias("k"))
    plan = J.lookup_label(facts, dim, "k", "name")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    narrow = J.lookup_label(facts, dim.withColumn("name", F.lit("x")), "k", "name")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in narrow


def test_large_k_takes_the_same_path_as_small(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id", F.create_map(F.lit("a"), "id").alias("m"))
    for k in (3, 1000, 2000):
        found = O.top_k_per_group(df, "g", ["id"], k)
        assert found.groupBy("g").count().select("count").distinct().collect() == [(min(k, 1500),)] and found.columns == df.columns


def test_split_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k int")
    train, test = O.train_test_split(df, 0.5, "k", 1)
    assert train.count() + test.count() == 4 and test.filter("k is null").count() == 2


def test_scratch_is_removed(spark):
    with scratch(spark):
        kept = store(spark.range(5), "kept")
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_join_unnest_outer(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, [])], "id int, a array<int>")
    assert rows(J.join_unnest(df, "a", "v")) == [(1, 5), (1, 6)]
    assert rows(J.join_unnest(df, "a", "v", outer=True)) == [(1, 5), (1, 6), (2, None)]


def test_hash_uniform_is_uniform(spark):
    df = spark.range(20000).select(S.hash_uniform("id", 1).alias("u"), S.box_muller("id", 1, 5, 2).alias("z"))
    row = df.agg(F.avg("u").alias("u"), F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("z").alias("z"), F.stddev("z").alias("s")).first()
    assert abs(row["u"] - 0.5) < 0.01 and row["lo"] >= 0 and row["hi"] < 1
    assert abs(row["z"] - 5) < 0.05 and abs(row["s"] - 2) < 0.05


def test_divide_never_fails(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 0.0), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(S.divide(F.col("a"), F.col("b"))).collect()] == [None, None, 2.0]
    assert [r[0] for r in df.select(S.divide(F.col("a"), F.col("b"), 0.0)).collect()] == [0.0, None, 2.0]


def test_transform_round_trip_and_unseen(spark, tmp_path):
    df = spark.createDataFrame([("b", 1.0, 9.0), ("a", 3.0, 9.0), (None, None, 9.0)], "c string, x double, k double")
    specs = [X.label_encoder("c", "code"), X.min_max_scaler("x", "s"), X.robust_scaler("k", "z"), X.pass_through("x", "raw")]
    fitted = X.FeatureTransform(specs).fit(df)
    assert rows(fitted.transform(df).select("code", "s", "z")) == [(0, None, 0.0), (1, 1.0, 0.0), (2, 0.0, 0.0)]
    fitted.save(spark, str(tmp_path / "t"))
    again = X.FittedTransform.load(spark, str(tmp_path / "t"))
    new = spark.createDataFrame([("zz", 2.0, 1.0)], "c string, x double, k double")
    assert rows(again.transform(new)) == rows(fitted.transform(new)) == [(0, 0.5, 0.0, 2.0)]


def test_many_categories_go_to_a_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(X, "SMALL_ROWS", 2)
    df = spark.createDataFrame([("b",), ("a",), ("d",), ("c",), (None,)], "c string")
    fitted = X.FeatureTransform([X.label_encoder("c", "code")]).fit(df)
    assert fitted.code_tables and rows(fitted.transform(df, keep=["c"])) == [("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 0)]
    fitted.save(spark, str(tmp_path / "t"))
    assert rows(X.FittedTransform.load(spark, str(tmp_path / "t")).transform(df)) == [(0,), (1,), (2,), (3,), (4,)]


def test_vectors_round_trip(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    packed = X.assemble_vector(df, ["a", "b"]).select("features")
    assert rows(X.disassemble_vector(packed, "features", ["p", "q"])) == [(1.0, 2.0)]
    assert isinstance(X.disassemble_vector(packed, "features", ["p"]).schema["p"].dataType, T.DoubleType)
