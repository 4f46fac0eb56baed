"""Exact duplicates by distributed most-significant-digit radix partitioning.

A row's key is its text without white space, as bytes. Rows are split by successive digits of the key (runs of
bytes that widen with depth) until a group is a single row or its keys have ended; rows whose keys ended in one
group are equal byte by byte, so no digest decides anything. Each task first splits its own batches, so of many
copies one row per batch goes on: the digits that move between tasks, and the joins on them, stay small for
every key. Depth costs one aggregation and one join over the rows that still share all their bytes so far.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import store
from .common import SPACE, few_ids, fresh

BLANKS = b" \t\n\v\f\r"
#: Bytes of the digits by depth; the last one repeats.
WIDTHS = (64, 4096, 262144)


def equal_groups(keys: list[bytes], first: int = 16, most: int = 65536) -> list[list[int]]:
    """Places of equal keys: buckets by successive digits until single or ended."""
    found, todo = [], [(list(range(len(keys))), 0, first)]
    while todo:
        members, at, width = todo.pop()
        buckets: dict[bytes, list[int]] = {}
        for i in members:
            buckets.setdefault(keys[i][at : at + width], []).append(i)
        for digit, bucket in buckets.items():
            if len(bucket) == 1 or len(digit) < width:
                found.append(bucket)
            else:
                todo.append((bucket, at + width, min(2 * width, most)))
    return found


def _split_batches(batches, id_at: int, text_at: int, schema: pa.Schema, width: int):
    next_row = TaskContext.get().partitionId() << 36
    for batch in batches:
        n = len(batch)
        text = pc.fill_null(batch.column(text_at).cast(pa.string()), "")
        chars = pc.utf8_length(text).to_pylist()
        ids = batch.column(id_at).cast(pa.int64()).to_pylist()
        keys = [t.translate(None, BLANKS) for t in text.cast(pa.binary()).to_pylist()]
        lead, size, best = [0] * n, [0] * n, [False] * n
        for members in equal_groups(keys):
            stays = min(members, key=lambda i: (-chars[i], ids[i] is None, ids[i] or 0, i))  # noqa: B023
            best[stays] = True
            for i in members:
                lead[i], size[i] = stays, len(members)
        columns = [
            pc.if_else(pa.array(best), c, pa.scalar(None, c.type)) if k == text_at else c
            for k, c in enumerate(batch.columns)
        ]
        columns += [
            pa.array(range(next_row, next_row + n), pa.int64()), pa.array([next_row + i for i in lead], pa.int64()),
            pa.array([ids[i] for i in lead], pa.int64()), pa.array(size, pa.int64()), pa.array(chars, pa.int64()),
            pa.array([hashlib.sha256(k).digest() for k in keys], pa.binary()), pa.array([k[:width] for k in keys], pa.binary()),
        ]
        next_row += n
        yield pa.RecordBatch.from_arrays(columns, names=schema)


class _Split:
    """The stored rows with what their batch says of them, and the names of the added columns."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.columns, self.id, self.text = docs.columns, id_col, text_col
        names = ("row", "lead", "lead_id", "copies", "chars", "sha", "digit")
        added = {n: fresh(f"radix_{n}", docs.columns) for n in names}
        kinds = [T.LongType()] * 5 + [T.BinaryType()] * 2
        schema = T.StructType(docs.schema.fields + [T.StructField(added[n], k) for n, k in zip(names, kinds, strict=True)])
        split = partial(
            _split_batches, id_at=docs.columns.index(id_col), text_at=docs.columns.index(text_col), schema=schema.names,
            width=WIDTHS[0],
        )
        self.rows = store(docs.mapInArrow(split, schema), "radix-rows")
        self.row, self.lead, self.lead_id, self.copies, self.chars, self.sha, self.digit = (F.col(added[n]) for n in names)

    def leads(self) -> DataFrame:
        return self.rows.filter(self.row == self.lead)


def _classes(split: _Split) -> DataFrame:
    """(row, class) of the leading rows that equal a leading row of another batch.

    Only row numbers, classes and the digits themselves move: a deeper digit is read from the stored texts of the rows
    that share all their digits so far, where these lie.
    """
    leads = split.leads()
    here = leads.select(split.row.alias("row"), F.lit(0).cast("bigint").alias("class"), split.digit.alias("digit"))
    key = F.regexp_replace(F.coalesce(F.col(f"`{split.text}`").cast("string"), F.lit("")), SPACE, "").cast("binary")
    keys = leads.select(split.row.alias("row"), key.alias("key"))
    found, depth, start = None, 0, 0
    while True:
        width = WIDTHS[min(depth, len(WIDTHS) - 1)]
        groups = here.groupBy("class", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("next"))
        # Stored, so that the join on it can split the rows of a digit that very many texts share.
        groups = store(groups.filter("n > 1").select("class", "digit", "next"), "radix-digits")
        # Keys shorter than the digit have ended: what shares it is equal.
        active = here.join(groups, ["class", "digit"]).select("row", F.col("next").alias("class"), (F.length("digit") < width).alias("ended"))
        active = store(active, "radix-shared")
        done = active.filter("ended").select("row", "class")
        found = done if found is None else found.unionByName(done)
        deeper = active.filter("not ended").select("row", "class")
        if deeper.isEmpty():
            return found
        start, depth = start + width, depth + 1
        digit = F.substring("key", start + 1, WIDTHS[min(depth, len(WIDTHS) - 1)])
        here = keys.join(few_ids(deeper), "row").select("row", "class", digit.alias("digit"))


def _decisions(split: _Split) -> DataFrame:
    """Of the rows in ``_classes``: row, group_size, keep_id and keep_row of their class."""
    known = split.leads().select(
        split.row.alias("row"), F.col(f"`{split.id}`").cast("long").alias("id"), split.copies.alias("copies"), split.chars.alias("chars")
    )
    found = store(_classes(split), "radix-classes")
    order = F.struct(-F.col("chars"), F.col("id").isNull(), "id", "row")
    classes = known.join(found, "row").groupBy("class").agg(F.sum("copies").alias("group_size"), F.min(order).alias("first"))
    return found.join(classes, "class").select("row", "group_size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without their white space; NULL counts as empty, and empty texts equal each
    other. Of equal texts the longest original stays, then the smallest id (NULL last), then one of the repeated
    rows, so exactly one row of a group is kept. The digest is output only. Other columns are ignored; an empty
    table gives no rows.
    """
    split = _Split(docs.select(f"`{id_col}`", f"`{text_col}`"), id_col, text_col)
    narrow = split.rows.select(
        F.col(f"`{id_col}`").alias("doc_id"), split.row.alias("at"), split.lead.alias("row"), split.lead_id.alias("lead_id"),
        split.copies.alias("copies"), split.sha.alias("sha"),
    )
    known = F.col("keep_row").isNotNull()
    return narrow.join(_decisions(split), "row", "left").select(
        "doc_id", F.when(known, F.col("keep_id")).otherwise(F.col("lead_id")).alias("keep_id"),
        F.coalesce("group_size", "copies").alias("group_size"),
        (F.col("at") == F.coalesce("keep_row", "row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that ``copies`` keeps, with all their columns unchanged."""
    split = _Split(docs, id_col, text_col)
    gone = store(_decisions(split).filter("row != keep_row").select(F.col("row").alias("gone")), "radix-gone")
    # A NULL text leads its batch as the empty text and is NULL again here.
    return split.leads().join(few_ids(gone), split.row == F.col("gone"), "left_anti").select(*[f"`{c}`" for c in split.columns])
