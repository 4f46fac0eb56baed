"""The pipeline stage by stage against brute force, on a whole small table."""

import zlib
from collections import defaultdict

import pytest
from test_dedup import brute_groups, brute_print, normal
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from ringspan.llm import toxicity
from ringspan.llm.tokens import vocabulary_path
from ringspan.session import store

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SMALL), "test"))
    return out


def rows_of(frame):
    return {r["doc_id"]: tuple(r) for r in frame.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        have = rows_of(before)
        assert all(have[k] == v for k, v in rows_of(after).items()) and after.count() == len(rows_of(after))


def test_toxic_rows_go(spark, stages):
    before, after = rows_of(stages[0]), rows_of(stages[1])
    scorer = toxicity.Scorer(toxicity.fit(stages[0], spark.read.parquet(f"{SMALL}/labels.parquet")))
    assert set(after) == {k for k, r in before.items() if scorer.score((r[1] or "").encode()) < 0.5}
    assert 0.8 * len(before) < len(after) < len(before)


def test_one_of_equal_and_near_texts_stays(stages):
    groups = defaultdict(list)
    for k, r in rows_of(stages[1]).items():
        groups[normal(r[1])].append((-len(r[1]), k))
    assert set(rows_of(stages[2])) == {min(g)[1] for g in groups.values()}
    prints = defaultdict(list)
    for k, r in rows_of(stages[2]).items():
        prints[brute_print(r[1])].append(k)
    assert set(rows_of(stages[3])) == set(brute_groups(prints).values())


def test_documents_with_benchmark_items_go(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before, after = rows_of(stages[3]), rows_of(stages[4])
    exact = {k for k, r in before.items() if any(t in r[1] for t in items)}
    assert exact and not exact & set(after)
    words = {k: set(r[1].lower().split()) for k, r in before.items()}
    for k in set(before) - set(after) - exact:
        assert max(len(words[k] & set(t.lower().split())) / len(set(t.lower().split())) for t in items) > 0.6


def test_everything_left_is_packed(stages):
    library = Tokenizer.from_file(vocabulary_path())
    pieces = defaultdict(list)
    for r in stages[5].collect():
        pieces[r["doc_id"]].append(r)
    texts = {k: r[1] for k, r in rows_of(stages[4]).items()}
    assert set(pieces) == set(texts)
    for k, found in list(pieces.items())[:200]:
        ids = [*library.encode(texts[k], add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            data = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r["length"]])
            assert r["start"] == at and zlib.crc32(data) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)


def test_registered(spark, stages):
    found = entry_points.queries()
    assert "pipeline" in found and sum(n.startswith("op") and n[2:3].isdigit() for n in found) == 13
    assert found["pipeline"](spark, SMALL).count() == stages[5].count()


def test_empty_tables(spark):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, empty, SMALL)
        assert found.collect() == []
