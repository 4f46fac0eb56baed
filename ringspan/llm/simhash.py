"""Near duplicates by SimHash fingerprints linked through BK-trees.

Fingerprints are linked at a small Hamming distance. Of 64 bits in ``distance + 2`` blocks at least two blocks agree
between linked fingerprints, so the distinct fingerprints are dealt by every pair of blocks and each shard builds
one BK-tree: children keyed by their integer distance to the parent, a search following only the edges within the
radius. A shard that is large is dealt again by blocks of its remaining bits, of which ``distance + 1`` leave one
equal. So the trees travel by shuffle with bounded size and no tree over all fingerprints is ever broadcast; a shard
gives a spanning forest, not its pairs.
"""

from __future__ import annotations

from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import store
from .common import arrow_schema, few_ids, fresh
from .graph import components

BITS = 64
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of whole UTF-8 bytes: a bit is set if set in over half the XXH64 values of the shingles.

    Words are runs without white space, with A-Z in lower case; a text of fewer words is one shingle, and one
    without words gives 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    size = min(shingle, len(words))
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(words) - size + 1
    for at in range(0, n, _BLOCK):
        upto = min(at + _BLOCK, n)
        h = [digest(joined[a:b], 42) for a, b in zip(starts[at:upto], ends[at + size - 1 : upto + size - 1], strict=True)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches, text_at: int, keep_text: bool, shingle: int, schema: list[str]):
    next_row = TaskContext.get().partitionId() << 36
    for batch in batches:
        text = pc.fill_null(batch.column(text_at).cast(pa.string()), "").cast(pa.binary())
        found = np.array([fingerprint(t, shingle) for t in text.to_pylist()], np.uint64).view(np.int64)
        columns = [c for i, c in enumerate(batch.columns) if keep_text or i != text_at]
        rows = pa.array(range(next_row, next_row + len(batch)), pa.int64())
        next_row += len(batch)
        yield pa.RecordBatch.from_arrays([*columns, rows, pa.array(found)], names=schema)


class BKTree:
    """Integers by Hamming distance: a node's children are keyed by their distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        here = 0 if self.values else -1
        while here >= 0:
            d = (value ^ self.values[here]).bit_count()
            if d == 0:
                return
            after = self.children[here].get(d, -1)
            if after < 0:
                self.children[here][d] = len(self.values)
            here = after
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Places of the values at ``radius`` or less, following only edges that can lead there."""
        found, todo = [], [0] if self.values else []
        while todo:
            here = todo.pop()
            d = (value ^ self.values[here]).bit_count()
            if d <= radius:
                found.append(here)
            children = self.children[here]
            todo += [children[k] for k in range(d - radius, d + radius + 1) if k in children]
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A forest of links (smallest value of the group, value) among the distinct values of a shard."""
    tree = BKTree()
    parent: list[int] = []

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for value in sorted(set(values)):
        near = tree.within(value, radius)
        new = len(tree.values)
        tree.add(value)
        parent.append(new)
        for other in near:
            a, b = top(other), top(new)
            parent[max(a, b)] = min(a, b)
    return [(tree.values[top(i)], v) for i, v in enumerate(tree.values) if top(i) != i]


_LINK, _LINK_DDL = arrow_schema(u="long", v="long")


def _search(batches, radius: int):
    for batch in batches:
        links: list[tuple[int, int]] = []
        for values in batch.column(0).to_pylist():
            signed = shard_links([v & (1 << BITS) - 1 for v in values], radius)
            links += signed
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_LINK)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _split_bits(mask: int, parts: int) -> list[int]:
    """The bits of ``mask`` in ``parts`` runs of about equal number."""
    bits = [1 << i for i in range(BITS) if mask >> i & 1]
    return [sum(bits[i * len(bits) // parts : (i + 1) * len(bits) // parts]) for i in range(parts)]


def links(values: DataFrame, distance: int = 2, shard_rows: int = 2000) -> DataFrame:
    """Links (u, v) that connect the distinct ``fp`` values as all links at ``distance`` or fewer bits would.

    Shards of up to ``shard_rows`` values get a BK-tree; larger ones are dealt again until few bits remain, where
    a shard is small because its values differ.
    """
    everything = (1 << BITS) - 1
    blocks = _split_bits(everything, distance + 2)
    masks = [a | b for a, b in combinations(blocks, 2)]
    dealt = values.select("fp", F.explode(F.array([F.lit(_signed(m)) for m in masks])).alias("mask"))
    found = None
    while True:
        dealt = dealt.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        left = min(BITS - m.bit_count() for m in masks)
        large = None
        if left > distance + 1:
            counted = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows)
            large = store(counted.select("mask", "value"), "large-shards")
            if large.isEmpty():
                large = None
        small = dealt if large is None else dealt.join(large, ["mask", "value"], "left_anti")
        shards = small.groupBy("mask", "value").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
        more = shards.select("fps").mapInArrow(partial(_search, radius=distance), _LINK_DDL)
        found = more if found is None else found.unionByName(more)
        if large is None:
            return found
        finer = {m: [m | b for b in _split_bits(everything & ~m, distance + 1)] for m in masks}
        by_mask = F.create_map([x for m, f in finer.items() for x in (F.lit(_signed(m)), F.array([F.lit(_signed(y)) for y in f]))])
        dealt = store(
            dealt.join(large, ["mask", "value"], "left_semi").select("fp", F.explode(by_mask[F.col("mask")]).alias("mask")).distinct(),
            "large-shards",
        )
        masks = sorted({y for f in finer.values() for y in f})


class _Printed:
    """Stored rows with a row number and a fingerprint, and the component of each fingerprint."""

    def __init__(self, docs: DataFrame, text_col: str, keep_text: bool, shingle: int, distance: int):
        self.row, self.fp = fresh("simhash_row", docs.columns), fresh("simhash_fp", docs.columns)
        kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
        schema = T.StructType(kept + [T.StructField(n, T.LongType()) for n in (self.row, self.fp)])
        text_at = docs.columns.index(text_col)
        read = partial(_fingerprints, text_at=text_at, keep_text=keep_text, shingle=shingle, schema=schema.names)
        self.rows = store(docs.mapInArrow(read, schema), "fingerprints")
        distinct = store(self.rows.select(F.col(self.fp).alias("fp")).distinct(), "distinct-fingerprints")
        roots = components(links(distinct, distance))
        self.roots = store(
            distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root")), "roots"
        )

    def first(self, order) -> DataFrame:
        """(fp, first): of each fingerprint's component the smallest ``order``; combined per fingerprint first."""
        own = self.rows.groupBy(F.col(self.fp).alias("fp")).agg(F.min(order).alias("first")).join(self.roots, "fp")
        return own.join(own.groupBy("root").agg(F.min("first").alias("least")), "root").select("fp", F.col("least").alias("first"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest id reachable).

    NULL texts count as empty; texts without words share the fingerprint zero and are linked like any others;
    repeated rows appear again; NULL ids are passed over for the component unless it has no other; other columns are
    ignored; an empty table gives no rows.
    """
    printed = _Printed(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "text", False, shingle, distance)
    first = printed.first(F.col("doc_id"))
    return printed.rows.join(first, F.col(printed.fp) == F.col("fp")).select(
        "doc_id", F.lower(F.lpad(F.hex(F.col(printed.fp)), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The row with the smallest id (NULL last) of each group of near duplicates, all its columns unchanged.

    Of repeated ids one row stays.
    """
    printed = _Printed(docs, text_col, True, shingle, distance)
    row = F.col(printed.row)
    first = printed.first(F.struct(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), row))
    other = printed.rows.select(F.col(printed.fp).alias("fp"), row.alias("gone")).join(first, "fp").filter(F.col("gone") != F.col(f"first.{printed.row}"))
    gone = few_ids(store(other.select("gone"), "near-copies"))
    return printed.rows.join(gone, row == F.col("gone"), "left_anti").select(*[f"`{c}`" for c in docs.columns])
