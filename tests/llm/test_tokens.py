"""Encoding, packing and token files against whole encoding and brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ringspan.llm import packing, queries, token_files
from ringspan.llm.tokens import encoder, vocabulary_path

SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "a \n b\tc  ", "it's we'll  they're x'd", "naïve Straße ſ ² Ⅷ x́y",
    "<|endoftext|> a <|endoftext|>", "x <|endoftext|>", "日本 語 テスト", "\x1c a \x85 b \xa0 c", "%%% a*** b&&&, c.. 12 3.5x", "é" * 500,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def expected_ids(library, text, end):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length string, start string")


def odd_rows():
    rows = [(i, t, "x", None, "y") for i, t in enumerate(ODD)]
    long = " ".join(f"word{i} and" for i in range(4000))
    return rows + [(100, long, None, None, None), (101, long, None, None, None), (101, long, None, None, None), (None, "no id", None, None, None)]


def test_pieces_encode_like_whole_texts(library):
    found = list(encoder(vocabulary_path()).documents(pa.array(ODD, pa.string())))
    assert [f.tolist() for f in found] == [library.encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'sé1*ÀB"), st.characters(codec="utf-8")), max_size=40), max_size=5))
def test_any_text_encodes_like_the_library(texts):
    library = encoder(vocabulary_path())
    found = list(library.documents(pa.array(texts, pa.string())))
    assert [f.tolist() for f in found] == [library.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def check_packed(rows, docs, library, window, end):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    texts = defaultdict(list)
    for d in docs:
        texts[d[0]].append(d[1])
    assert set(pieces) == set(texts)
    for doc_id, found in pieces.items():
        want = Counter()
        for t in texts[doc_id]:
            ids = expected_ids(library, t, end)
            want[len(ids)] += 1
            for r in found:
                if r["doc_tokens"] == len(ids) and len(set(texts[doc_id])) == 1:
                    assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"]
        assert sum(r["length"] for r in found) == sum(k * n for k, n in want.items())
        if len(texts[doc_id]) == 1:
            at = 0
            for r in sorted(found, key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
    padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padded += 0 if at.bit_count() == 1 else window - at
    assert padded < window
    return padded


@pytest.mark.parametrize("window", [8, 64, 1024])
def test_packing_odd_rows(spark, library, window):
    docs = odd_rows()
    rows = packing.pack_documents(frame(spark, docs), vocabulary_path(), window, 0, with_ids=True).collect()
    check_packed(rows, docs, library, window, 0)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


def test_packing_empty_table(spark):
    assert packing.pack_documents(frame(spark, []), vocabulary_path()).collect() == []


def test_packing_query(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op1_packing"](spark, SMALL).collect()
    check_packed(rows, docs, library, 1024, 0)


@given(st.lists(st.integers(0, 9), min_size=1, max_size=33), st.integers(0, 32), st.integers(0, 5000))
@settings(max_examples=60, deadline=None)
def test_plans_place_every_piece_once(counts, hot, more):
    window = 32
    h = np.zeros(window + 1, np.int64)
    h[: len(counts)] = counts
    h[0] = 0
    if hot:
        h[hot] += more
    plan = packing.plan_windows(h, window)
    placed, cut = Counter(), Counter()
    rows = plan["pieces"]
    for i, r in enumerate(rows):
        k, first = divmod(int(r[0]), packing.RANKS)
        after = int(rows[i + 1][0]) if i + 1 < len(rows) and rows[i + 1][0] // packing.RANKS == k else k * packing.RANKS + int(h[k])
        placed[k] += after - int(r[0])
        if r[1] < 0:
            for p in packing.binary_parts(k):
                cut[p] += after - int(r[0])
    assert all(placed[k] == h[k] for k in range(window + 1))
    assert set(cut) == {int(k) // packing.RANKS for k in plan["parts"][:, 0]}


def test_least_squares_counts_fit_a_plannable_histogram():
    counts = np.zeros(101, np.int64)
    counts[60], counts[40], counts[30], counts[70] = 50, 50, 20, 20
    combos = packing.combinations(counts, 100)
    x = packing.solve_counts(combos, counts)
    used = np.zeros(101)
    for combo, n in zip(combos, x, strict=True):
        for k in combo[combo > 0]:
            used[k] += n
    assert np.abs(used - counts).max() < 0.5


def brute_files(library, docs, end):
    start, out = 0, []
    for doc_id, text, *_ in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = expected_ids(library, text, end)
        out.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_token_files_odd_rows(spark, library, tmp_path):
    docs = odd_rows()
    shards = token_files.write_token_files(frame(spark, docs), str(tmp_path / "ids"), vocabulary_path(), 2)
    rows = token_files.read_token_files(shards, str(tmp_path / "ids")).collect()
    found = sorted((r["shard"], r["position"], r["doc_id"], r["before"], r["n_tokens"], r["ids_crc32"]) for r in rows if r["doc_id"] is not None)
    want = brute_files(library, docs, 2)
    assert [f[2:] for f in found] == want[1:]
    assert [(r["before"], r["n_tokens"]) for r in rows if r["doc_id"] is None] == [(0, want[0][2])]
    # One document alone, by the index.
    dictionary = token_files.read_dictionary(str(tmp_path / "ids"))
    place = next(r for r in rows if r["doc_id"] == 100)
    path = next(r["path"] for r in shards.collect() if r["shard"] == place["shard"])
    reader = token_files.ShardReader(path, dictionary)
    assert reader.document(place["position"]).tolist() == expected_ids(library, docs[len(ODD)][1], 2).tolist()
    with pytest.raises(ValueError):
        token_files.ShardReader(path, dictionary + b"x")


def test_token_files_empty_table(spark, tmp_path):
    shards = token_files.write_token_files(frame(spark, []), str(tmp_path / "ids"), vocabulary_path(), 2)
    assert token_files.read_token_files(shards, str(tmp_path / "ids")).collect() == []


def test_token_files_query(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(tuple(r) for r in queries.QUERIES["op6_token_files"](spark, SMALL).collect())
    assert rows == sorted(brute_files(library, docs, 2))


@pytest.mark.parametrize("chars", [20_000, 300_000])
def test_batches_do_not_change_ids(spark, monkeypatch, chars):
    from ringspan.llm import tokens

    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    tool = tokens.Encoder(vocabulary_path(), remembered=5000)
    monkeypatch.setattr(tokens, "BATCH_CHARS", chars)
    assert [f.tobytes() for f in tool.documents(pa.array(texts))] == [tool.whole(t or "") for t in texts]
