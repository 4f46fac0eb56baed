"""How work is dealt at size, shown on small rows."""

import pytest
from pyspark.sql import functions as F

from ringspan.operators import aggregates as A
from ringspan.operators import joins as J
from ringspan.operators import ranges, trees
from ringspan.operators import text as X
from ringspan.operators.features import FittedTransform, pass_through
from ringspan.sources import readers as R


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_inline_rows_are_the_side_that_is_broadcast(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_returnflag", "l_quantity")
    names = R.inline_rows(spark, [("R", True), ("A", False), (None, True)], "l_returnflag string, back boolean")
    joined = J.join_using(lines, names, "l_returnflag")
    assert "BroadcastHashJoin" in executed(joined) and "BuildRight" in executed(joined) and "BuildLeft" not in executed(joined)
    assert joined.count() == lines.filter("l_returnflag in ('R', 'A')").count()
    assert R.inline_rows(spark, [], "a int").collect() == []


@pytest.mark.parametrize("rows", [0, 1, 60])
def test_few_large_rows_of_unknown_size_are_parted(spark, monkeypatch, rows):
    monkeypatch.setattr(ranges, "BYTES_PER_RANGE", 5000)
    df = spark.createDataFrame([(i, "w" * 1000) for i in range(rows)], "id int, t string")
    assert (len(ranges.Ranges(df, F.lit(1), [], [F.col("id")]).bounds) > 2) == (rows == 60)
    chunks = A.string_agg(df, F.col("t"), "", ["id"], max_chars=2500).orderBy("chunk").collect()
    assert "".join(c["text"] for c in chunks) == "w" * (1000 * rows)


def test_rows_of_trees_are_dealt_by_their_number(spark, monkeypatch):
    rows = spark.range(400).select((F.col("id") % 9).cast("double").alias("x"), (F.col("id") % 9 * 2.0).alias("y")).coalesce(1)
    fit = lambda: trees.fit_boosted_tree_regressor(rows, "y", FittedTransform([pass_through("x")]), max_iter=3, learn_rate=1.0, subsample=1.0)
    seen, dealt = [], trees._dealt
    monkeypatch.setattr(trees, "_dealt", lambda *a: seen.append(dealt(*a)) or seen[-1])
    before = {r["x"]: r["predicted_y"] for r in trees.predict(fit(), rows).collect()}
    monkeypatch.setattr(trees, "PARTITION_VALUES", 100)
    after = {r["x"]: r["predicted_y"] for r in trees.predict(fit(), rows).collect()}
    assert [s.rdd.getNumPartitions() for s in seen] == [1, 4]
    assert after == pytest.approx(before) and len(after) == 9


def test_texts_move_to_the_shuffled_retrieval_and_not_their_words(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, "the dog"), (None, "the cat")], "doc_id int, text string")
    questions = spark.createDataFrame([(7, "the CAT?")], "question_id int, text string")
    found = X.retrieve_documents(docs, questions, 2, max_broadcast_terms=0)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    moved = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert any("Generate explode" in line for line in plan[:moved])


@pytest.mark.parametrize("legacy", [False, True])
def test_a_number_is_searched_once(spark, legacy):
    numbers = ["0014155", "+0014155", "++14155", "000", "00", "+", "0", "14155", None, "1\n00"]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    found = J.country_of_number(df, "n", {"1": "A", "14": "B", "0": "Z", "100": "L"}, legacy=legacy)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1

    def country(n):
        n = n.removeprefix("+")
        n = ("1" + n if legacy else n[2:]) if n.startswith("00") else n
        return next((c for p, c in (("100", "L"), ("14", "B"), ("1", "A"), ("0", "Z")) if n.startswith(p)), None)

    assert {r["n"]: r["country"] for r in found.collect()} == {n: n and country(n) for n in numbers}
