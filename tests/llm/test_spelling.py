"""Spelling variants against comparing every two words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ringspan.llm import spelling as S


def one_edit(a, b):
    """Whether two words differ by exactly one code point put in, left out or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(docs):
    found = Counter()
    for d in docs:
        doc_id, text = d[0], d[1] or ""
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def expected(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(rows, key=lambda r: r[0])


def variants(spark, docs, **more):
    frame = spark.createDataFrame(docs, "doc_id long, text string, word string, n string").repartition(3)
    return sorted(map(tuple, S.spelling_variants(frame, **more).collect()), key=lambda r: r[0])


def noisy_docs():
    rng = random.Random(3)
    base = ["colour", "colours", "harbour", "internationalisation", "aaaaaaa", "éclairÀ", "ÿöñßéà", "banana", "anagram", "abcabcabc"]
    letters = "abcdeéÀÿz"
    words = list(base)
    for _ in range(250):
        w = list(rng.choice(words))
        at = rng.randrange(len(w))
        way = rng.randrange(3)
        if way == 0:
            w[at] = rng.choice(letters)
        elif way == 1:
            w.insert(at, rng.choice(letters))
        elif len(w) > 6:
            del w[at]
        words.append("".join(w))
    docs = []
    for i in range(60):
        docs.append((i, " ".join(rng.choice(words[: rng.choice([10, 60, len(words)])]) for _ in range(200)), "x", "y"))
    return docs


@pytest.mark.parametrize("part_words", [4000, 5])
def test_against_every_two_words(spark, part_words):
    docs = noisy_docs()
    want = expected(counted(docs))
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] and r[1] for r in want)
    assert variants(spark, docs, part_words=part_words) == want


def test_whole_small_table(spark, sf):
    docs = [(r["doc_id"], r["text"], None, None) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    words = counted(docs)
    assert variants(spark, docs) == expected(words)


def test_odd_rows(spark):
    same = "Überall überall ÜBERALL ".upper()
    long = "x" * 3000
    docs = [(None, None, "a", "b"), (1, "", None, None), (2, "short words of a b c", None, None), (None, same * 7, None, None), (3, same * 7, "", "")]
    docs += [(3, same * 7, "", ""), (4, f"{long} {long}y " * 9, None, None), (5, "× ÷ foo×bar÷baz " * 6, None, None)]
    found = variants(spark, docs)
    assert found == expected(counted(docs)) and len(found) >= 4
    assert S.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert variants(spark, docs[:3]) == []


def test_chains_lead_to_the_last_form(spark):
    docs = [(i, " ".join(["handel"] * 700 + ["handels"] * 100 + ["handelss"] * 12), "", "") for i in range(1)]
    found = {r[0]: r for r in variants(spark, docs, every=1 << 40)}
    assert found["handelss"][1:3] == ("handels", "handel") and found["handels"][1:3] == ("handel", "handel") and found["handel"][1:3] == (None, "handel")


@settings(max_examples=400, deadline=None)
@given(st.sets(st.text(alphabet="abc", max_size=7), max_size=60))
def test_the_composition_accepts_each_pair_once(words):
    found = list(S.Composition(S.Acceptor(sorted(words))).pairs())
    want = {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    assert len(found) == len(want) and {frozenset(p) for p in found} == want


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="ab", max_size=8), max_size=60))
def test_the_acceptor_is_minimal(words):
    acceptor = S.Acceptor(sorted(words))
    own = S.Composition(acceptor)
    reached, todo = {0}, [0]
    while todo:
        new = set(acceptor.arcs[todo.pop()].values()) - reached
        reached |= new
        todo += new
    ends = [frozenset(own.language(s)) for s in reached]
    assert len(set(ends)) == len(ends) and set(own.language(0)) == words
