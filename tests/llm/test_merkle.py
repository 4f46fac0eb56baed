"""Merkle manifests against a tree built in one piece."""

import hashlib
import zlib

import duckdb
import pytest

from ringspan.llm import merkle, queries

FIELDS = "doc_id long, source string, lang string, n_chars long, text string, tree int, pos string, digest int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def up(nodes):
    return [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]


def ways(nodes):
    """(top, for every node the (place, run) of each level)."""
    found, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            found[i].append((a % 16, nodes[a // 16 * 16 : a // 16 * 16 + 16]))
        nodes, at = up(nodes), [a // 16 for a in at]
    return nodes[0], found


def expected(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted([r for r in rows if r[1] == s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    inner = {s: ways([leaf(r) for r in t]) for s, t in trees.items()}
    root, outer = ways([inner[s][0] for s in sources])
    out = []
    for s, above in zip(sources, outer, strict=True):
        for r, way in zip(trees[s], inner[s][1], strict=True):
            path, node = way + above, leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                lower = "".join(c.lower() if c.isascii() else c for c in r[4])
                node = leaf((*r[:4], lower))
            for place, run in path:
                node = h("".join([*run[:place], node, *run[place + 1 :]]))
            proof = h("".join("".join(run[:place] + run[place + 1 :]) for place, run in path))
            out.append((r[0], leaf(r), inner[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


def made(n, sources):
    return [(i * 7 % n, sources(i), "en" if i % 3 else None, i, f"Text {i} É" if i % 11 else None, 1, "x", 2) for i in range(n)]


CASES = {
    "one row": [(1, "a", "en", 3, "Abc", 0, "", 0)],
    "runs that just fill": made(16, lambda i: "s") + made(17, lambda i: "t") + made(256, lambda i: "u") + made(257, lambda i: "v"),
    "a hot source": made(1400, lambda i: "hot" if i % 3 else f"s{i % 40}"),
    "many sources": made(700, lambda i: f"é{i % 300}" if i % 5 else None),
    "odd rows": [
        (None, None, None, None, None, 0, "", 0), (None, "a", None, 0, "", 0, "", 0), (5, "a", "", -3, "X" * 100_000, 0, "", 0),
        (5, "a", "", -3, "X" * 100_000, 0, "", 0), (5, "a", "de", 1, "Ä a", 0, "", 0), (7, "", "de", 1, "\U0001f600", 0, "", 0),
    ],
}


@pytest.mark.parametrize("name", CASES)
def test_against_one_piece(spark, name):
    rows = CASES[name]
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    assert sorted(map(tuple, merkle.manifest_proofs(docs).collect()), key=str) == expected(rows)


def test_empty(spark):
    found = merkle.manifest_proofs(spark.createDataFrame([], FIELDS))
    assert found.collect() == [] and found.columns[0] == "doc_id"


def test_only_every_second_level_is_stored(spark):
    manifest = merkle.Manifest(spark.createDataFrame(CASES["a hot source"], FIELDS))
    n = manifest.leaves.filter("tree = 'hot'").count()
    assert [level.filter("tree = 'hot'").count() for level in manifest.levels] == [n, -(-n // 256), 1]


def test_sql_states_the_same(spark, sf):
    found = queries.QUERIES["op12_merkle_manifest"](spark, sf)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    wanted = con.execute(queries.ORACLES["op12_merkle_manifest"]).fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str) and 0 < sum(r[-1] for r in wanted) < len(wanted)
