"""Merkle manifest of a dataset with proofs, by checkpoint and recomputation.

Every row is a leaf, every source a tree over its leaves in order, and the subroots of the sources the leaves of one
more tree. 16 consecutive nodes make one of the next level. Only every second level is stored: a stored node stands
for an aligned subtree of 256 stored descendants. Proofs go top down the same way: each subtree gets the path of its
own top once, regenerates the level it did not store from its stored nodes, hands every node its siblings, and
discards them. So neither the interior levels nor a proof per leaf are ever written, and no tree is in one task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..operators.ordered import row_number
from ..session import store
from .common import arrow_schema, ascii_lower

#: Nodes of a run, and of the subtree between two stored levels.
RUN, SUBTREE = 16, 256
#: Leaves that one task may number; a larger source is parted.
RANGE_LEAVES = 1_000
_PATH = "array<struct<place:int, run:array<string>>>"


def field(value: Column) -> Column:
    """A value as the leaf's input has it: ``-`` if NULL, else UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def tampered(doc_id: Column) -> Column:
    """Whether a document's text is lower-cased before its proof is checked; a NULL id is left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, forged): the digest of each row and, where its text is tampered with, that of the forged row."""
    column = {c: F.col(f"`{c}`") for c in ("doc_id", "source", "lang", "n_chars", "text")}
    digest = lambda text: F.sha2(F.concat(*[field(column[c]) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)
    return docs.select(
        column["doc_id"].cast("long").alias("doc_id"), column["source"].cast("string").alias("tree"), digest(column["text"]).alias("leaf"),
        F.when(tampered(column["doc_id"]), digest(ascii_lower(column["text"].cast("string")))).alias("forged"),
    )


def _runs(nodes: Column) -> Column:
    """The level above some consecutive nodes."""
    last = F.floor((F.size(nodes) - 1) / RUN).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(nodes, i * RUN + 1, RUN), ""), 256))


def _same_tree(a: str, b: str) -> Column:
    return F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree"))


def _subtrees(nodes: DataFrame, sizes: DataFrame, step: int) -> DataFrame:
    """(tree, subtree, nodes, whole): the stored nodes of every subtree in order; ``whole`` if it is all of its tree.

    ``nodes`` are (tree, pos, digest) and what else the subtree is to carry; all of it is in ``nodes``.
    """
    own = F.struct("pos", "digest", *[c for c in nodes.columns if c not in ("tree", "pos", "digest")])
    grouped = nodes.groupBy("tree", F.shiftright("pos", 8).alias("subtree")).agg(F.sort_array(F.collect_list(own)).alias("nodes"))
    joined = grouped.alias("g").join(broadcast_if_small(sizes).alias("s"), _same_tree("g", "s"))
    return joined.select("g.*", (F.col("s.size") <= F.lit(SUBTREE) ** (step + 1)).alias("whole"))


def _levels(nodes: DataFrame, sizes: DataFrame) -> list[DataFrame]:
    """The stored levels (tree, pos, digest) over ``nodes``; the last one has one node per tree."""
    levels, largest = [nodes], sizes.agg(F.max("size")).first()[0] or 1
    while SUBTREE ** (len(levels) - 1) < largest or len(levels) == 1:
        below = _subtrees(levels[-1].select("tree", "pos", "digest"), sizes, len(levels) - 1)
        below = below.select("tree", "subtree", "whole", F.col("nodes.digest").alias("nodes"))
        once = below.withColumn("once", _runs(F.col("nodes")))
        # A whole tree ends at one node, which may be one level up or none; any other subtree stands two levels up.
        top = F.when(F.col("whole") & (F.size("nodes") == 1), F.col("nodes")[0]).when(
            F.col("whole") & (F.size("once") == 1), F.col("once")[0]
        ).otherwise(F.sha2(F.array_join("once", ""), 256))
        levels.append(store(once.select("tree", F.col("subtree").alias("pos"), top.alias("digest")), "merkle-level"))
    return levels


def _steps(size: Column, place: Column, once: Column, nodes: Column, whole: Column) -> Column:
    """The path of the node at a place of a subtree upto the subtree's top."""
    run = F.floor(place / RUN).cast("int")
    low = F.struct((place % RUN).cast("int").alias("place"), F.slice(nodes, run * RUN + 1, RUN).alias("run"))
    high = F.struct(run.alias("place"), once.alias("run"))
    none = F.array().cast(_PATH)
    return F.when(whole & (size == 1), none).when(whole & (size <= RUN), F.array(low)).otherwise(F.array(low, high))


def _paths(levels: list[DataFrame], sizes: DataFrame, tops: DataFrame) -> DataFrame:
    """(tree, pos, path, rest...) of the nodes of the first stored level above the leaves.

    ``tops`` has what is above each tree: (tree, path, rest...), and ``rest`` is handed down.
    """
    rest = [c for c in tops.columns if c not in ("tree", "path")]
    paths = tops.withColumn("pos", F.lit(0).cast("bigint"))
    for step in reversed(range(1, len(levels) - 1)):
        below = _subtrees(levels[step], sizes, step).withColumn("nodes", F.col("nodes.digest"))
        below = below.withColumn("once", _runs(F.col("nodes"))).alias("b")
        joined = below.join(paths.alias("p"), _same_tree("b", "p") & (F.col("b.subtree") == F.col("p.pos")))
        each = joined.select("b.*", F.col("p.path").alias("above"), *[f"p.{c}" for c in rest], F.posexplode("nodes").alias("place", "digest"))
        own = _steps(F.size("nodes"), F.col("place"), F.col("once"), F.col("nodes"), F.col("whole"))
        paths = store(
            each.select("tree", (F.col("subtree") * SUBTREE + F.col("place")).alias("pos"), F.concat(own, F.col("above")).alias("path"), *rest),
            "merkle-paths",
        )
    return paths


_PROOF, _PROOF_DDL = arrow_schema(
    doc_id="long", leaf="string", subroot="string", root="string", proof_sha256="string", folded_root="string", verified="boolean"
)


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def siblings_of(path: list[tuple[int, list[str]]]) -> str:
    """The proof: the other nodes of every run, level by level, left to right."""
    return "".join("".join(run[:place]) + "".join(run[place + 1 :]) for place, run in path)


def folded(node: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a node and the siblings on its path give."""
    for place, run in path:
        node = digest_of("".join(run[:place]) + node + "".join(run[place + 1 :]))
    return node


def _prove(batches):
    """Per subtree of leaves: regenerate its interior level, fold each leaf's path, emit the digests."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            leaves, whole = row["nodes"], row["whole"]
            nodes = [n["digest"] for n in leaves]
            once = [digest_of("".join(nodes[i : i + RUN])) for i in range(0, len(nodes), RUN)]
            above = [(p["place"], p["run"]) for p in row["path"]]
            if not (whole and len(nodes) <= RUN):
                highs = [[(i, once), *above] for i in range(len(once))]
            else:
                highs = [above]
            for i, n in enumerate(leaves):
                alone = whole and len(nodes) == 1
                path = above if alone else [(i % RUN, nodes[i // RUN * RUN : i // RUN * RUN + RUN]), *highs[i // RUN]]
                root = folded(n["digest"] if n["forged"] is None else n["forged"], path)
                out.append((n["doc_id"], n["digest"], row["subroot"], row["root"], digest_of(siblings_of(path)), root, root == row["root"]))
        columns = list(zip(*out, strict=True)) or [()] * len(_PROOF)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PROOF, strict=True)], schema=_PROOF)


def _sizes(nodes: DataFrame) -> DataFrame:
    return store(nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "merkle-sizes")


class Manifest:
    """The stored levels of all trees: of each source over its rows, and of the subroots."""

    def __init__(self, docs: DataFrame):
        leaves = store(_leaves(docs), "merkle-leaves")
        placed = row_number(leaves, ["doc_id", "leaf"], "n", by=["tree"], rows_per_range=RANGE_LEAVES)
        self.leaves = store(
            placed.select("tree", (F.col("n") - 1).alias("pos"), F.col("leaf").alias("digest"), "doc_id", "forged"), "merkle-level"
        )
        self.sizes = _sizes(self.leaves)
        self.levels = _levels(self.leaves, self.sizes)
        subroots = self.levels[-1].select(F.col("tree").alias("source"), "digest")
        ordered = row_number(subroots, [F.asc_nulls_first("source")], "n")
        self.subroots = store(ordered.select(F.lit("").alias("tree"), (F.col("n") - 1).alias("pos"), "digest", "source"), "merkle-level")
        self.top_sizes = _sizes(self.subroots)
        self.top = _levels(self.subroots, self.top_sizes)

    def root(self) -> str | None:
        """The digest of the whole dataset; None if it is empty."""
        found = self.top[-1].first()
        return found and found["digest"]

    def _source_paths(self) -> DataFrame:
        """(tree, path, subroot) of each source: the way from its subroot to the root."""
        none = self.top_sizes.select("tree", F.array().cast(_PATH).alias("path"))
        upper = _paths(self.top, self.top_sizes, none).alias("p")
        below = _subtrees(self.subroots, self.top_sizes, 0).withColumn("digests", F.col("nodes.digest"))
        below = below.withColumn("once", _runs(F.col("digests"))).alias("b")
        joined = below.join(upper, _same_tree("b", "p") & (F.col("b.subtree") == F.col("p.pos")))
        each = joined.select("b.*", F.col("p.path").alias("above"), F.posexplode("nodes").alias("place", "node"))
        own = _steps(F.size("digests"), F.col("place"), F.col("once"), F.col("digests"), F.col("whole"))
        return store(
            each.select(F.col("node.source").alias("tree"), F.concat(own, F.col("above")).alias("path"), F.col("node.digest").alias("subroot")),
            "merkle-paths",
        )

    def proofs(self) -> DataFrame:
        """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
        paths = _paths(self.levels, self.sizes, self._source_paths()).alias("p")
        below = _subtrees(self.leaves, self.sizes, 0).alias("b")
        joined = below.join(paths, _same_tree("b", "p") & (F.col("b.subtree") == F.col("p.pos")))
        rows = joined.select("b.nodes", "b.whole", "p.path", "p.subroot", F.lit(self.root()).cast("string").alias("root"))
        return rows.mapInArrow(_prove, _PROOF_DDL)


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text) and every row's proof, checked.

    Per row: doc_id, leaf, subroot (of its source), root (of all), proof_sha256 (of the siblings from leaf to root),
    folded_root (from the leaf, or from the leaf with A-Z of the text in lower case where 5 divides the crc32 of the
    id, and the original siblings), verified (it equals root). NULL is a value of its own in every column; rows with
    NULL sources are one tree, the first; a NULL id comes first in its tree and is never tampered with; rows that
    repeat an id are ordered by their leaf; a lone leaf is its subroot, and a lone subroot the root; other columns are
    ignored; an empty table gives no rows.
    """
    return Manifest(docs).proofs()
