"""Two-tier token counts against encoding whole texts."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ringspan.llm import token_counts as C
from ringspan.llm.tokens import vocabulary_path

SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "a \n b\tc  ", "\n\n x \n", "it's we'll  they're x'd", "naïve Straße ſ ² Ⅷ x́y",
    "<|endoftext|> a <|endoftext|>", "x <|endoftext|>", "日本 語 テスト", "\x1c a \x85 b \xa0 c", "%%% a*** b&&&, c.. 12 3.5x", "é" * 500,
    "word " * 30_000, "x" * 100_000, "  y 　 z", "a​ b",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def whole(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def no_table():
    return C.Table(pa.array([], pa.large_string()), pa.array([], pa.int64()).to_numpy())


@pytest.fixture(scope="module")
def counters():
    table = C.Table(pa.array(["a", "s", "B."], pa.large_string()), pa.array([1, 1, 2]).to_numpy())
    return [C.Counts(vocabulary_path(), t) for t in (table, no_table())]


def test_odd_texts(spark, library):
    rows = [(i, t, "x", 5) for i, t in enumerate(ODD)] + [(None, "no id", None, None), (3, "twice", "", 0), (3, "twice", "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    found = C.token_counts(df, vocabulary_path(), limit=100).collect()
    want = [(r[0], len((r[1] or "").encode()), whole(library, r[1]), whole(library, r[1]) > 100) for r in rows]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert C.token_counts(df.limit(0), vocabulary_path()).collect() == []


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r["doc_id"]: r for r in C.token_counts(docs, vocabulary_path()).collect()}
    for d in docs.collect():
        n = whole(library, d["text"])
        assert tuple(found[d["doc_id"]]) == (d["doc_id"], len((d["text"] or "").encode()), n, n > 1024)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'sé1*ÀB"), st.characters(codec="utf-8")), max_size=40), max_size=5))
def test_any_text_counts_like_the_library(counters, texts):
    for counts in counters:
        assert counts(pa.array(texts, pa.string())).tolist() == [whole(counts.own.tokenizer, x) for x in texts]


def test_tiers(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    table = C.fit_table(docs, vocabulary_path(), entries=500)
    assert 0 < len(table.parts) <= 500
    counts = C.Counts(vocabulary_path(), table)
    texts = pa.array([r["text"] for r in docs.select("text").collect()], pa.string())
    counts(texts)
    first = dict(counts.seen)
    counts(texts)
    assert first["table"] > 0 and first["encoded"] > 0
    assert counts.seen["encoded"] - first["encoded"] < first["encoded"] // 10  # remembered by the worker


def test_memory_is_bounded(monkeypatch, library):
    monkeypatch.setattr(C, "REMEMBERED", 10)
    counts = C.Counts(vocabulary_path(), no_table())
    texts = [f"w{i} x{i} y" for i in range(200)]
    assert counts(pa.array(texts)).tolist() == [whole(library, t) for t in texts]
    assert len(counts.memory) <= 10 and len(counts.firsts) <= 10


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_encode_whole(spark, name):
    texts = ["Some words  here", "", "déjà vu <|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))
        want = [len(model.encode(t)) for t in texts]
    else:
        want = [whole(Tokenizer.from_file(vocabulary_path(name)), t) for t in texts]
    found = C.token_counts(df, vocabulary_path(name)).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in found] == want
