"""Texts, retrieval, overlap scores, embeddings, neighbours."""

import json
from collections import Counter

import numpy as np
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ringspan.operators import embeddings as E
from ringspan.operators import neighbours as K
from ringspan.operators import quantiser as Q
from ringspan.operators import text as X


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, [float(v) for v in rng.normal(size=8)], "hot" if i % 3 == 0 else str(i % 4)) for i in range(600)]
    data += [(600 + i, data[i][1], "copy") for i in range(20)]  # exact copies
    return spark.createDataFrame(data, "vec_id int, embedding array<double>, label string").repartition(5).cache()


def brute(vectors, queries, k, cost, crowd=None, limit=None):
    base = [(r["vec_id"], np.array(r["embedding"]), r["label"]) for r in vectors.collect()]
    found = []
    for q in queries.collect():
        ranked = sorted((round(cost(np.array(q["embedding"]), v), 9), i, label) for i, v, label in base)
        seen, kept = Counter(), []
        for c, i, label in ranked:
            seen[label] += 1
            if limit is None or seen[label] <= limit:
                kept.append(i)
        found += [(q["vec_id"], i, n) for n, i in enumerate(kept[:k], 1)]
    return sorted(found)


def l2(a, b):
    return float(np.sqrt(((a - b) ** 2).sum()))


@pytest.mark.parametrize("metric, cost", [
    ("l2", l2), ("dot", lambda a, b: -float(a @ b)),
    ("cosine", lambda a, b: -float(a @ b) / float(np.linalg.norm(a) * np.linalg.norm(b))),
])
def test_knn_equals_brute_force(vectors, metric, cost):
    queries = vectors.filter("vec_id % 50 = 0")
    found = K.knn_exact(vectors, queries, 7, metric)
    assert rows(found.select("query", "id", "rank")) == brute(vectors, queries, 7, cost)


@pytest.mark.parametrize("metric, cells", [("l2", 7), ("l2", 40), ("dot", 7), ("cosine", 12)])
def test_knn_does_not_depend_on_the_cells(vectors, metric, cells):
    queries = vectors.filter("vec_id % 40 = 0")
    assert rows(K.knn_exact(vectors, queries, 5, metric, cells=cells)) == rows(K.knn_exact(vectors, queries, 5, metric))


def test_knn_in_blocks_equals_one_block(vectors, monkeypatch):
    queries = vectors.filter("vec_id % 40 = 0")
    expected = rows(K.knn_exact(vectors, queries, 5))
    monkeypatch.setattr(K, "BLOCK_ROWS", 10)
    assert rows(K.knn_exact(vectors, queries, 5, cells=3)) == expected == rows(K.knn_exact(vectors, queries, 5))


def clustered(spark, n, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(scale=20.0, size=(30, 6))
    return spark.createDataFrame([(i, (centres[i % 30] + rng.normal(size=6)).tolist()) for i in range(n)], "vec_id int, embedding array<double>")


def test_the_share_of_rows_met_falls(spark):
    """What a query is measured against, at two sizes: a small and falling share of the base."""
    shares = []
    for n, cells in ((600, 30), (2400, 120)):
        base = clustered(spark, n)
        met = K.rows_met(base, base.filter("vec_id % 50 = 0"), 5, cells=cells).collect()
        assert len(met) == n // 50 and max(r["cells"] for r in met) < cells
        shares.append(sum(r["rows"] for r in met) / len(met) / n)
    assert shares[1] < shares[0] < 0.35


def test_knn_of_odd_vectors(spark):
    """Vectors without length, equal vectors, NULL vectors, far fewer rows than k, and empty sides."""
    base = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [-2.0, 0.0]), (5, None), (6, [0.0, 5.0]), (7, [0.0, 0.0])],
        "vec_id int, embedding array<double>",
    )
    for metric in ("l2", "dot", "cosine"):
        for k, cells in ((1, 6), (20, 3)):
            found = [rows(K.knn_exact(base, base, k, metric, cells=c)) for c in (1, cells)]
            assert found[0] == found[1] and len(found[0]) == 6 * min(k, 6)
    assert K.knn_exact(base.limit(0), base, 3).count() == 0 and K.knn_exact(base, base.limit(0), 3, cells=2).count() == 0


def test_no_side_goes_through_the_driver():
    import inspect

    assert "toPandas" not in inspect.getsource(K.knn_exact) + inspect.getsource(K._meetings) + inspect.getsource(K._search_blocks)


def test_knn_crowding_and_filter(vectors):
    queries = vectors.filter("vec_id % 100 = 0")
    expected = brute(vectors.filter("vec_id < 610"), queries, 6, l2, limit=2)
    in_cells = K.knn_exact(vectors, queries, 6, crowd_col="label", crowding=2, where="vec_id < 610", cells=9)
    assert rows(in_cells.select("query", "id", "rank")) == expected
    found = K.knn_exact(vectors, queries, 6, crowd_col="label", crowding=2, where="vec_id < 610")
    assert rows(found.select("query", "id", "rank")) == brute(vectors.filter("vec_id < 610"), queries, 6, l2, limit=2)


def test_knn_full_row_and_more_than_there_is(vectors):
    few = vectors.filter("vec_id < 3")
    found = K.knn_join(few, few, 10, full_row=True)
    assert found.count() == 9 and "label" in found.columns


def test_knn_approx(vectors, monkeypatch):
    queries = vectors.filter("vec_id % 20 = 0")
    exact = set(rows(K.knn_exact(vectors, queries, 10).select("query", "id")))
    everywhere = set(rows(K.knn_approx(vectors, queries, 10, leaves=8, probes=8).select("query", "id")))
    assert everywhere == exact
    some = K.knn_approx(vectors, queries, 10, leaves=8, probes=4)
    pairs = set(rows(some.select("query", "id")))
    assert len(pairs & exact) / len(exact) > 0.7
    monkeypatch.setattr(K, "BLOCK_ROWS", 50)
    assert set(rows(K.knn_approx(vectors, queries, 10, leaves=8, probes=4).select("query", "id"))) == pairs


def test_codes_come_near_the_distance():
    rng = np.random.default_rng(4)
    residuals = rng.normal(size=(3000, 10))
    books = [Q.kmeans(residuals[:, s : s + 4], 256, 1) for s in (0, 4, 8)]
    quantiser, query = Q.Quantiser(books), rng.normal(size=10)
    about, true = quantiser.distances(quantiser.codes(residuals), query), ((residuals - query) ** 2).sum(1)
    assert np.corrcoef(about, true)[0, 1] > 0.9
    few = Q.Quantiser([Q.kmeans(np.array([[1.0], [1.0], [5.0]]), 256, 1)])  # fewer values than a byte has: no error is left
    assert few.distances(few.codes(np.array([[1.0], [5.0]])), np.array([2.0])).tolist() == [1.0, 9.0]


def test_short_leaves_are_made_up_for(spark):
    points = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(0.0)).alias("embedding"))
    found = K.knn_approx(points, points, 10, leaves=16, probes=1).groupBy("query").count()
    assert found.count() == 40 and found.filter("count <> 10").count() == 0


def test_overlap_scores_of_nulls_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a b c", "a b"), (1, "x y", "z"), (2, None, "a"), (3, "a", None)], "id int, t string, p string")
    one = sorted(tuple(r) for r in X.rouge_n(df, "id", "t", "p", 1).select("id", "rouge1_precision", "rouge1_recall").collect())
    assert one == [(1, 0.0, 0.0), (1, 1.0, 2 / 3), (2, 0.0, 0.0), (3, 0.0, 0.0)]
    longest = sorted(tuple(r) for r in X.rouge_l(df, "id", "t", "p").select("id", "rougeL_precision", "rougeL_recall").collect())
    assert longest == one


def test_tuning_split_is_null_safe(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    train, held = X.split_tuning_rows(df, ["k"], n=2)
    assert train.count() + held.count() == 3 and train.unionByName(held).distinct().count() == 3


def test_index_reads_only_probed_leaves(spark, vectors, tmp_path):
    K.build_index(vectors, str(tmp_path / "index"), leaves=8)
    found = K.search_index(spark, str(tmp_path / "index"), vectors.filter("vec_id = 7"), 3, probes=2)
    assert found.orderBy("rank").first()["id"] == 7
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_leaf" in plan


def test_radius_sweep_equals_single_radii(vectors):
    sweep = {r["radius"]: r["outliers"] for r in E.radius_sweep(vectors, "label", "embedding", [2.0, 2.8, 3.5]).collect()}
    for radius, n in sweep.items():
        assert E.class_outliers(vectors, "label", "embedding", radius).count() == n


def test_one_row_class_has_distance_zero(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None)], "c string, v array<double>")
    assert [r["distance"] for r in E.class_distances(df, "c", "v").collect()] == [0.0]


def test_projection_orders_variance(vectors):
    plane = E.project_2d(vectors, "embedding")
    row = plane.agg(F.var_samp("x").alias("x"), F.var_samp("y").alias("y")).first()
    assert row["x"] >= row["y"] > 0
    assert E.plane_centroids(plane, "label").count() == vectors.select("label").distinct().count()


def test_embed_text(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, "a b b"), (3, "")], "id int, t string")
    found = {r["id"]: r["embedding"] for r in E.embed_text(df, "t", dim=16).collect()}
    assert found[1] == found[2] and np.linalg.norm(found[1]) == pytest.approx(1) and not any(found[3])
    own = E.embed_text(df, "t", fn=lambda texts: [[len(t), 1] for t in texts]).collect()
    assert sorted(r["embedding"] for r in own) == [[0.0, 1.0], [5.0, 1.0], [5.0, 1.0]]


def test_parse_embeddings(spark):
    chunks = spark.createDataFrame([("a", None), ("b", [9.0])], "id string, embedding array<double>")
    payload = json.dumps([{"embeddings": {"values": [1, 2.5]}}])
    predictions = spark.createDataFrame([("a", payload), ("b", "not json")], "id string, predictions string")
    assert rows(E.parse_embeddings(chunks, predictions, "id")) == [("a", [1.0, 2.5]), ("b", [9.0])]


def test_clean_text(spark):
    df = spark.createDataFrame([("From: a.b-c@d.e (Ann Lee)\nSubject: hi there",)], "t string")
    assert X.clean_text(df, "t").first()[0] == " hi there"
    assert X.clean_text(df, "t", max_chars=3).first()[0] == " hi"


def test_chunks_cover_the_text(spark):
    text = " ".join(f"w{i}" for i in range(47))
    df = spark.createDataFrame([(1, text), (2, "  "), (3, "one\ntwo")], "id int, t string")
    chunks = X.chunk_text(df, "id", "t", 10, 3).orderBy("id", "chunk").collect()
    words = [c["text"].split() for c in chunks if c["id"] == 1]
    joined = words[0] + [w for part in words[1:] for w in part[3:]]
    assert " ".join(joined) == text and all(a[-3:] == b[:3] for a, b in zip(words, words[1:]))
    assert [c["chunk_id"] for c in chunks if c["id"] != 1] == ["3:0"]
    with pytest.raises(ValueError):
        X.chunk_text(df, "id", "t", 3, 3)


def test_retrieval_ranks_rare_words_first(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, "the dog"), (3, "the the the"), (4, "Cat, cat!")], "doc_id int, text string")
    questions = spark.createDataFrame([(7, "the CAT?"), (8, "zebra")], "question_id int, text string")
    found = [(r["question_id"], r["doc_id"], r["rank"]) for r in X.retrieve_documents(docs, questions, 2).collect()]
    assert sorted(found) == [(7, 1, 2), (7, 4, 1)] or sorted(found) == [(7, 1, 1), (7, 4, 2)]
    broadcast = rows(X.retrieve_documents(docs, questions, 3))
    assert rows(X.retrieve_documents(docs, questions, 3, max_broadcast_terms=0)) == broadcast


def test_retrieval_by_bounds_equals_joins(spark):
    """Many ties, words of very different frequency, repeated questions and documents, odd rows."""
    rng = np.random.default_rng(12)
    word = lambda: f"w{int(rng.zipf(1.4)) % 300}"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(1, 40))))) for i in range(600)] + [(5, "w1 w2"), (None, "w3 w4"), (700, None), (701, "")]
    asked = [(i, " ".join(word() for _ in range(int(rng.integers(1, 12))))) for i in range(40)] + [(3, "w1 w1"), (90, None), (91, "zebra")]
    docs = spark.createDataFrame(docs, "doc_id int, text string").repartition(5)
    asked = spark.createDataFrame(asked, "question_id int, text string")
    for k in (1, 7):
        assert rows(X.retrieve_documents(docs, asked, k)) == rows(X.retrieve_documents(docs, asked, k, max_broadcast_terms=0))
    assert X.retrieve_documents(docs.limit(0), asked).count() == 0 and X.retrieve_documents(docs, asked.limit(0)).count() == 0


def test_rouge_identity_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c", "a b c"), (2, "", "x"), (3, "a b a", "b a b")], "id int, t string, p string")
    one = {r["id"]: r for r in X.rouge_n(df, "id", "t", "p", 1).collect()}
    assert one[1]["rouge1_fmeasure"] == 1.0 and one[2]["rouge1_recall"] == 0.0 and len(one) == 3
    assert one[3]["rouge1_precision"] == pytest.approx(2 / 3)
    longest = {r["id"]: r for r in X.rouge_l(df, "id", "t", "p").collect()}
    assert longest[1]["rougeL_fmeasure"] == 1.0 and longest[3]["rougeL_recall"] == pytest.approx(2 / 3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_common_length_equals_table(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert X._common_length(a, b) == table[-1][-1]


def test_text_model_keeps_failed_rows(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "mute")], "id int, p string")

    def answer(prompts, suffix):
        if "bad" in prompts:
            raise RuntimeError("refused")
        return [None if p == "mute" else p + suffix for p in prompts]

    found = rows(X.apply_text_model(df.coalesce(1), "p", answer, suffix="!"))
    assert found == [(1, "ok", "ok!", None), (2, "bad", None, "refused"), (3, "mute", None, "blocked")]


def test_prompts_hold_every_row(spark):
    df = spark.range(200).select("id", F.concat(F.lit("v"), "id").alias("v"))
    prompts = X.build_prompts(df, "Look:", ["id", "v"], ["id"], max_chars=120).orderBy("chunk").collect()
    assert all(p["prompt"].startswith("Look:\n") and p["prompt"].endswith("\nid bigint, v string") for p in prompts)
    lines = [line for p in prompts for line in p["prompt"].split("\n")[1:-1]]
    assert lines == [f"{i},v{i}" for i in range(200)]
    assert X.schema_text(df).first()[0] == "id bigint, v string"


def test_corpus_index(spark):
    files = spark.createDataFrame([("b.py", True, "B"), ("a.md", True, "A"), ("c.bin", False, None)], "path string, is_text boolean, text string")
    found = {r["part"]: r["text"] for r in X.corpus_index(files).collect()}
    assert found["index"] == "a.md\nb.py\nc.bin"
    assert found["content"].startswith("----- File: a.md -----\nA\n----") and "c.bin" not in found["content"]


def test_conversations_and_pairs(spark):
    talk = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (2, 0, "user", "q")],
        "conv_id int, turn int, role string, text string",
    )
    history = {r["conv_id"]: [m["text"] for m in r["messages"]] for r in X.conversation_history(talk, "conv_id", "turn", 3).collect()}
    assert history == {1: ["q1", "a1", "q2"], 2: ["q"]}
    pairs = X.build_tuning_pairs(talk).collect()
    assert [json.loads(p["value"]) for p in pairs] == [{"messages": [{"role": "user", "content": "q1"}, {"role": "model", "content": "a1"}]}]


def test_validation_rules(spark):
    good = {"messages": [{"role": "user", "content": "a"}, {"role": "model", "content": "b"}]}
    lines = [json.dumps(good), "no json", json.dumps({"messages": []}),
             json.dumps({"messages": [{"role": "bot", "content": "a"}, {"role": "model", "content": "b"}]}),
             json.dumps({"messages": [{"role": "model", "content": "a"}, {"role": "user", "content": " "}]})]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    found = {r["rule"]: r["failures"] for r in X.validate_tuning_rows(df, "classification").collect()}
    assert found == {"schema": 2, "roles": 1, "order": 2, "content": 1, "size": 495}


def test_split_has_at_most_250(spark):
    df = spark.range(1000).select("id")
    train, held = X.split_tuning_rows(df, ["id"])
    assert held.count() == 250 and train.count() == 750
    with pytest.raises(ValueError):
        X.split_tuning_rows(df, ["id"], n=251)


def test_labelled_corpus(spark):
    df = spark.createDataFrame([(i, f"t{i}", i % 3) for i in range(60)], "id int, text string, label int")
    dim = spark.createDataFrame([(0, "sci.a"), (1, "sci.b"), (2, "rec")], "label int, name string")
    found = X.labelled_corpus(df, dim, "label", "name", 5, "id", contains="sci")
    assert {r["name"]: r["count"] for r in found.groupBy("name").count().collect()} == {"sci.a": 5, "sci.b": 5}


def test_default_probes_find_nine_of_ten_neighbours(spark):
    """The share of the leaves searched does not shrink with the table."""
    import numpy as np

    from ringspan.operators import neighbours

    vectors = np.random.default_rng(3).normal(size=(6000, 12))
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    asked = base.filter("vec_id < 100")
    found = neighbours.knn_approx(base, asked, 10).collect()
    near = {i: set(np.argsort(((vectors - vectors[i]) ** 2).sum(axis=1))[:10].tolist()) for i in range(100)}
    recall = sum(r["id"] in near[r["query"]] for r in found) / 1000
    assert recall >= 0.9, recall


def test_the_calibrated_share_falls_as_the_table_grows(spark, tmp_path):
    """Defaults at two sizes: 0.9 of the neighbours are found, and the larger index is searched in a smaller part."""
    shares = []
    for n in (1500, 6000):
        base = clustered(spark, n)
        vectors = np.array([r["embedding"] for r in base.orderBy("vec_id").collect()])
        K.build_index(base, str(tmp_path / f"i{n}"))
        found = K.search_index(spark, str(tmp_path / f"i{n}"), base.filter("vec_id % 50 = 1"), 10).collect()
        near = {i: set(np.argsort(((vectors - vectors[i]) ** 2).sum(axis=1))[:10].tolist()) for i in range(1, n, 50)}
        assert len(found) == 10 * len(near) and sum(r["id"] in near[r["query"]] for r in found) >= 0.9 * len(found)
        shares.append(K.index_share(spark, str(tmp_path / f"i{n}")))
    assert shares[1] < shares[0] <= 0.25
