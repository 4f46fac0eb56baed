"""Exact and near duplicates against brute force."""

import random
from collections import defaultdict

import duckdb
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ringspan.llm import graph, queries, radix, simhash

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, radix_row string, simhash_row int, radix_digit string, m map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, None, {"a": 1}) for r in rows], SCHEMA)


def odd_rows():
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "A b"), (8, "x" * 64), (9, "x" * 65), (10, "x" * 64 + " "),
        (11, long), (12, long + "\n"), (13, long + "z"), (14, "x" * 4160), (15, "x" * 4161), (16, "x" * 4160), (4, "a b"), (4, "a b"),
        (None, "q q"), (None, "qq"), (20, "qq"), (21, "\x1c a"), (22, "a"), (23, "a\xa0"), (24, "é" * 40), (25, "é" * 40), (4, "other text"),
    ]
    return rows + [(100 + i, "the same old line") for i in range(300)]


def normal(text):
    return "".join(c for c in (text or "") if c not in " \t\n\v\f\r")


def groups_of(rows):
    found = defaultdict(list)
    for doc_id, text in rows:
        found[normal(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {k: (min(v)[3], len(v)) for k, v in found.items()}


def test_copies_odd_rows(spark):
    rows = odd_rows()
    want = groups_of(rows)
    found = radix.copies(frame(spark, rows).repartition(7)).collect()
    assert len(found) == len(rows)
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(want)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    expected = sorted(str((d, *want[normal(t)])) for d, t in rows)
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"])) for r in found) == expected


def test_drop_copies_keeps_columns(spark):
    rows = odd_rows()
    docs = frame(spark, rows).repartition(5)
    found = radix.drop_copies(docs)
    assert found.schema.simpleString() == docs.schema.simpleString()
    want = groups_of(rows)
    kept = [(r["doc_id"], r["text"]) for r in found.collect()]
    assert sorted(normal(t) for _, t in kept) == sorted(want)
    assert all(want[normal(t)][0] == d for d, t in kept)
    assert radix.drop_copies(frame(spark, [])).collect() == [] and radix.copies(frame(spark, [])).collect() == []


@given(st.lists(st.binary(max_size=6).map(lambda b: b * 7), max_size=40))
@settings(max_examples=80, deadline=None)
def test_local_radix_groups(keys):
    found = radix.equal_groups(keys, first=2)
    assert sorted(i for g in found for i in g) == list(range(len(keys)))
    assert sorted(keys[g[0]] for g in found) == sorted(set(keys))
    assert all(len({keys[i] for i in g}) == 1 for g in found)


def test_copies_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = sorted(con.execute(f"select {','.join(names)} from ({queries.ORACLES['op7_exact_dedup']})").fetchall())
    assert sorted(tuple(r[n] for n in names) for r in queries.QUERIES["op7_exact_dedup"](spark, SMALL).collect()) == want


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance=2):
    ids = {p: min(d for d in v if d is not None) for p, v in prints.items()}
    values, seen, out = list(prints), set(), {}
    for p in values:
        if p in seen:
            continue
        group, todo = [], [p]
        seen.add(p)
        while todo:
            x = todo.pop()
            group.append(x)
            near = [q for q in values if q not in seen and (q ^ x).bit_count() <= distance]
            seen.update(near)
            todo += near
        least = min(ids[x] for x in group)
        out.update(dict.fromkeys(group, least))
    return out


def check_simhash(found, rows):
    prints = defaultdict(list)
    for d, t in rows:
        prints[brute_print(t)].append(d)
    least = brute_groups(prints)
    want = sorted(str((d, f"{brute_print(t):016x}", least[brute_print(t)])) for d, t in rows)
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in found) == want


def simhash_rows():
    rng = random.Random(3)
    base = [rng.choice("the of and in a to it was on with".split()) + str(rng.randrange(40)) for _ in range(400)]
    rows = [(d, t) for d, t in odd_rows() if d is not None]
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(400)] = f"new{rng.randrange(5)}"
        rows.append((1000 + i, " ".join(words)))
    return rows + [(2000, "One"), (2001, "one TWO"), (2002, "ONE two three"), (2003, "É é"), (2004, "é É")]


def test_simhash_odd_rows(spark):
    rows = simhash_rows()
    check_simhash(simhash.simhash_groups(frame(spark, rows).repartition(5)).collect(), rows)
    assert simhash.simhash_groups(frame(spark, [])).collect() == []


def test_simhash_keeps_one_of_each(spark):
    rows = [r for r in simhash_rows() if r != (4, "other text")] + [(None, "no id at all here")]
    docs = frame(spark, rows).repartition(6)
    found = simhash.keep_one_of_each(docs)
    assert found.schema.simpleString() == docs.schema.simpleString()
    kept = [(r["doc_id"], r["text"]) for r in found.collect()]
    prints = defaultdict(list)
    for d, t in rows:
        prints[brute_print(t)].append(d if d is not None else 1 << 60)
    least = brute_groups(prints)
    assert sorted(least[brute_print(t)] for _, t in kept) == sorted(set(least.values()))
    assert all(least[brute_print(t)] == (d if d is not None else 1 << 60) for d, t in kept)


def test_simhash_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check_simhash(queries.QUERIES["op2_simhash"](spark, SMALL).collect(), rows)


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.lists(st.tuples(st.integers(0, 39), st.lists(st.integers(0, 63), max_size=3)), max_size=60))
@settings(max_examples=100, deadline=None)
def test_trees_find_all_near_values(values, changes):
    for at, bits in changes:
        if values:
            v = values[at % len(values)]
            for b in bits:
                v ^= 1 << b
            values.append(v)
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.values[i] for i in tree.within(v, 2)) == sorted(x for x in set(values) if (x ^ v).bit_count() <= 2)


@pytest.mark.parametrize("shard_rows", [3, 2000])
def test_links_in_small_shards(spark, shard_rows):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(30)]
    values = {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(12)} | set(centres)
    values |= {centres[0] ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(8)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), 2, shard_rows)
    roots = {r["node"]: r["root"] for r in graph.components(links).collect()}
    want = brute_groups({v: [v] for v in values})
    pairs = {}
    for v in values:
        s = v - (1 << 64) if v >> 63 else v
        pairs.setdefault(want[v], set()).add(roots.get(s, s))
    assert all(len(p) == 1 for p in pairs.values())
    assert len({next(iter(p)) for p in pairs.values()}) == len(pairs)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 900)]
    found = graph.components(spark.createDataFrame(chain + star + [(5, 5)], "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in found} == {(i, 100) for i in range(100, 161)} | {(i, 500) for i in range(500, 900)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).collect() == []
