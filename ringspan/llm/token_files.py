"""Token-id files: one zstandard frame per document under a shared dictionary, with an offset index.

Documents are dealt by ranges of their id, so shards and the documents in them ascend. A shard file is

    magic (8 bytes), bytes per id (u32), sha256 of the dictionary (32 bytes),
    the frames, each one document's ids as little-endian integers,
    the index: doc_id (i64), whether it is known (u8), number of ids (u64) and frame end (u64) per document, columnwise,
    where the index starts (u64), number of documents (u64), magic

A short document is read by its index entry alone. Files go to the shared folder through Arrow's file systems
under a name of the attempt and are then renamed, so a task that runs again leaves the same file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, store
from .common import arrow_schema, partitions_for
from .tokens import encoder

MAGIC = b"RSTOKEN1"
HEAD = len(MAGIC) + 4 + 32
_ENTRY = 25

_SAMPLE, _SAMPLE_DDL = arrow_schema(ids="binary")
_SHARD, _SHARD_DDL = arrow_schema(shard="long", path="string", n_docs="long", n_tokens="long", n_bytes="long")
_DOC, _DOC_DDL = arrow_schema(shard="long", position="long", doc_id="long", before="long", n_tokens="long", ids_crc32="long")


def _serialised(batches, path: str, end_id: int, width: int, most: int):
    for batch in batches:
        found = [ids[:most].astype(f"<u{width}").tobytes() for ids in encoder(path).documents(batch.column(0), end_id)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], schema=_SAMPLE)


def train_dictionary(
    docs: DataFrame, path: str, end_id: int, width: int, sample_docs: int = 1000, sample_ids: int = 4096,
    dict_bytes: int = 65536,
) -> bytes:
    """A dictionary fitted on the serialised ids of about ``sample_docs`` documents picked by a hash of their id.

    The sample is the bound: at most twice that many documents and ``sample_ids`` ids of each reach the driver.
    Too little data gives an empty dictionary.
    """
    rows = max(1, docs.count())
    share = min(1.0, sample_docs / rows)
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    picked = docs.filter(bucket).limit(2 * sample_docs).select("text")
    samples = [
        bytes(r[0]) for r in picked.mapInArrow(
            partial(_serialised, path=path, end_id=end_id, width=width, most=sample_ids), _SAMPLE_DDL
        ).collect()
    ]
    try:
        return zstandard.train_dictionary(dict_bytes, samples, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _frames(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


class ShardReader:
    """Reads a shard: ``document(i)`` one document by its index entry, ``documents()`` all, in order."""

    def __init__(self, path: str, dictionary: bytes):
        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        size = self.file.size()
        tail = self.file.read_at(24, size - 24)
        head = self.file.read_at(HEAD, 0)
        if tail[16:] != MAGIC or head[:8] != MAGIC:
            raise ValueError(f"{path} is no token file")
        if head[12:] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was written with another dictionary")
        self.width = int.from_bytes(head[8:12], "little")
        self.index, n = (int(x) for x in np.frombuffer(tail[:16], "<u8"))
        raw = self.file.read_at(n * _ENTRY, self.index)
        self.ids = np.frombuffer(raw, "<i8", n)
        self.known = np.frombuffer(raw, "u1", n, 8 * n).astype(bool)
        self.counts = np.frombuffer(raw, "<u8", n, 9 * n)
        self.ends = np.frombuffer(raw, "<u8", n, 17 * n)
        self.decompressor = zstandard.ZstdDecompressor(**_frames(dictionary))

    def _ids(self, frame: bytes, i: int) -> np.ndarray:
        data = self.decompressor.decompress(frame, max_output_size=max(1, int(self.counts[i]) * self.width))
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        start = int(self.ends[i - 1]) if i else HEAD
        return self._ids(self.file.read_at(int(self.ends[i]) - start, start), i)

    def documents(self, block: int = 8 << 20) -> Iterator[np.ndarray]:
        i, n = 0, len(self.ends)
        while i < n:
            start = int(self.ends[i - 1]) if i else HEAD
            upto = max(i + 1, int(np.searchsorted(self.ends, start + block, "right")))
            data = self.file.read_at(int(self.ends[upto - 1]) - start, start)
            for j in range(i, upto):
                a = int(self.ends[j - 1]) if j else HEAD
                yield self._ids(data[a - start : int(self.ends[j]) - start], j)
            i = upto

    def close(self) -> None:
        self.file.close()


def _write(batches, folder: str, path: str, end_id: int, width: int, dictionary: bytes, level: int):
    shard = TaskContext.get().partitionId()
    name = f"{folder}/ids-{shard:07d}.bin"
    system, inner = fs.FileSystem.from_uri(name)
    attempt = f"{inner}.{uuid.uuid4().hex}"
    compressor = zstandard.ZstdCompressor(level=level, write_checksum=False, write_dict_id=False, **_frames(dictionary))
    doc_ids, counts, ends, at = [], [], [], HEAD
    with system.open_output_stream(attempt) as out:
        out.write(MAGIC + width.to_bytes(4, "little") + hashlib.sha256(dictionary).digest())
        for batch in batches:
            doc_ids += batch.column(0).to_pylist()
            for ids in encoder(path).documents(batch.column(1), end_id):
                frame = compressor.compress(ids.astype(f"<u{width}").tobytes())
                at += len(frame)
                out.write(frame)
                counts.append(len(ids))
                ends.append(at)
        out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array([d is not None for d in doc_ids], "u1").tobytes())
        out.write(np.array(counts, "<u8").tobytes() + np.array(ends, "<u8").tobytes())
        out.write(np.array([at, len(ends)], "<u8").tobytes() + MAGIC)
    system.move(attempt, inner)
    row = [shard, name, len(ends), sum(counts), at + _ENTRY * len(ends) + 24]
    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SHARD, strict=True)], schema=_SHARD)


def _read(batches, dictionary: bytes, rows: int = 20_000):
    for batch in batches:
        for shard, path, base in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            reader = ShardReader(path, dictionary)
            before, out = base, []
            for i, ids in enumerate(reader.documents()):
                out.append((shard, i, int(reader.ids[i]) if reader.known[i] else None, before, len(ids), zlib.crc32(ids)))
                before += len(ids)
                if len(out) == rows or i + 1 == len(reader.ids):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _DOC, strict=True)], schema=_DOC)
                    out = []
            reader.close()


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    id_bytes: int | None = None, level: int = 3, shard_bytes: int = 64 << 20, sample_docs: int = 1000,
) -> DataFrame:
    """Write every document's ids, ``end_id`` behind them, to ``folder`` in ascending id order.

    Returns one row per shard (shard, path, n_docs, n_tokens, n_bytes) and leaves ``dictionary.zstd`` beside
    them. NULL and empty texts are the end id alone; NULL ids come first; rows of one id are ordered by text;
    an empty table writes empty shards. ``id_bytes`` is 2 or 4 by the size of the vocabulary if not given.
    """
    if id_bytes is None:
        id_bytes = 2 if max(encoder(path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    dictionary = train_dictionary(rows, path, end_id, id_bytes, sample_docs)
    system, inner = fs.FileSystem.from_uri(folder)
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/dictionary.zstd") as out:
        out.write(dictionary)
    # The hash spreads the rows of one repeated id over several shards.
    key = F.xxhash64("text")
    ranged = rows.repartitionByRange(partitions_for(rows, shard_bytes), F.col("doc_id"), key)
    write = partial(_write, folder=folder, path=path, end_id=end_id, width=id_bytes, dictionary=dictionary, level=level)
    return store(ranged.sortWithinPartitions(F.col("doc_id"), key, F.col("text")).mapInArrow(write, _SHARD_DDL), "shards")


def read_dictionary(folder: str) -> bytes:
    system, inner = fs.FileSystem.from_uri(f"{folder}/dictionary.zstd")
    with system.open_input_stream(inner) as source:
        return source.read()


def read_token_files(shards: DataFrame, folder: str) -> DataFrame:
    """Per document of the shards: shard, position, doc_id, before (ids of all earlier documents), n_tokens, ids_crc32."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row per shard
    based = shards.select("shard", "path", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).cast("long").alias("base"))
    dealt = based.filter(F.length("path") > 0).repartition(partitions_for(shards, 1 << 14), "shard")
    return dealt.mapInArrow(partial(_read, dictionary=read_dictionary(folder)), _DOC_DDL)


def token_file_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
