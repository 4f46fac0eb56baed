"""Token counts of whole texts by a two-tier lookup on the map side.

Texts are parted at spaces that always start a new pre-token; the number of tokens of a text is the sum over its
parts. The first tier is a compact table of frequent parts and their token counts, fitted on a bounded sample and
broadcast: it decides how fast a count is, never what it is. Parts it does not hold are encoded by the vocabulary's
library, and what they encode to is remembered by the worker process. Rows stay where they are; no part of a text is
shuffled.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, text_column

#: The table: documents it is fitted on, entries at most, and bytes of an entry at most, which bounds it to some MB.
SAMPLE_DOCS, ENTRIES, ENTRY_BYTES = 2_000, 65_536, 64
#: Parts a worker remembers, bytes of the longest one, and bytes of text handled at once.
REMEMBERED, REMEMBERED_BYTES, BATCH_BYTES = 300_000, 256, 8 << 20

#: A space before something that is not white space: byte-level pre-tokens never reach over its left side.
_CUT = re.compile(r" (?=\S)")


class Vocabulary:
    """Token counts by the library of a vocabulary file: tokenizers for ``.json``, sentencepiece for ``.model``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.special: list[str] = []
        self.parted = False
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: len(self.pieces.encode(text))
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.whole = lambda text: len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        with open(path, encoding="utf-8") as source:
            model = json.load(source)
        before = model.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in model.get("added_tokens") or ()]
        self.parted = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not model.get("normalizer") and not (model.get("model") or {}).get("dropout")
        )

    def part(self, part: str) -> int:
        """Tokens of a part that follows a space, with that space."""
        tokenize = self.tokenizer.model.tokenize
        return sum(len(tokenize(unit)) for unit, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(" " + part))

    def first(self, part: str) -> int:
        """Tokens of the part a text begins with."""
        tokenize = self.tokenizer.model.tokenize
        return sum(len(tokenize(unit)) for unit, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part))


def parts_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of the texts one behind the other, and where each text's begin (one number more than texts).

    Every text has a first part; the others follow a space.
    """
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets -= offsets[0]
    coded = flat.dictionary_encode()
    # A piece that is empty or begins with white space tells that its space is followed by white space.
    odd_names = np.fromiter((not p or p[0].isspace() for p in coded.dictionary.to_pylist()), bool, len(coded.dictionary))
    inside = odd_names[coded.indices.to_numpy()]
    inside[offsets[:-1]] = False
    odd = np.add.reduceat(inside, offsets[:-1]) > 0 if len(texts) else np.empty(0, bool)
    if not odd.any():
        return flat, offsets
    again = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
    sizes = np.diff(offsets)
    # Texts in runs of even and odd ones would be many slices: the parts of odd texts are put behind and taken in order.
    starts, cut_sizes = offsets[:-1].copy(), np.array([len(a) for a in again])
    starts[odd] = len(flat) + np.cumsum(cut_sizes) - cut_sizes
    sizes[odd] = cut_sizes
    both = pa.concat_arrays([flat, pa.array([p for a in again for p in a], flat.type)])
    ends = np.cumsum(sizes)
    take = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
    return both.take(pa.array(take)), np.concatenate([[0], ends])


def _frequent_parts(batches):
    """(part, n): parts of each batch that follow a space, as counted."""
    for batch in batches:
        flat, offsets = parts_of(pc.fill_null(batch.column(0).cast(pa.large_string()), ""))
        follows = np.ones(len(flat), bool)
        follows[offsets[:-1]] = False
        counted = flat.filter(pa.array(follows)).value_counts()
        yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.string()), counted.field(1).cast(pa.int64())], names=["part", "n"])


@dataclass
class Table:
    """Frequent parts and the tokens of each, in one Arrow array each."""

    parts: pa.Array
    tokens: np.ndarray


def fit_table(docs: DataFrame, vocabulary: str, text_col: str = "text", documents: int = SAMPLE_DOCS, entries: int = ENTRIES) -> Table:
    """The ``entries`` commonest parts of about ``documents`` documents, chosen by a hash of the whole text.

    Only speed depends on the sample.
    """
    own = Vocabulary(vocabulary)
    if not own.parted:
        return Table(pa.array([], pa.large_string()), np.empty(0, np.int64))
    text = text_column(text_col).cast("string").alias("text")
    share = min(1.0, documents / max(1, docs.count()))
    sample = docs.select(text).filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000)
    counted = sample.mapInArrow(_frequent_parts, "part string, n long").filter(F.octet_length("part") <= ENTRY_BYTES)
    best = counted.groupBy("part").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "part").limit(entries)
    names = [r["part"] for r in best.collect()]
    return Table(pa.array(names, pa.large_string()), np.array([own.part(p) for p in names], np.int64))


class Counts:
    """Counts for batches of texts with a table of frequent parts and a bounded memory of others."""

    def __init__(self, vocabulary: str, table: Table):
        self.own, self.table = Vocabulary(vocabulary), table
        self.memory: dict[str, int] = {}
        self.firsts: dict[str, int] = {}
        self.seen: Counter[str] = Counter()  # tier by which parts were found

    def _remembered(self, memory: dict[str, int], part: str, count) -> int:
        found = memory.get(part)
        if found is None:
            self.seen["encoded"] += 1
            found = count(part)
            if len(part) <= REMEMBERED_BYTES:
                if len(memory) >= REMEMBERED:
                    memory.clear()
                memory[part] = found
        else:
            self.seen["remembered"] += 1
        return found

    def parted(self, texts: pa.Array) -> np.ndarray:
        """Tokens of texts without special strings."""
        flat, offsets = parts_of(texts)
        coded = flat.dictionary_encode()
        names, index = coded.dictionary, coded.indices.to_numpy()
        tokens = np.zeros(len(names), np.int64)
        at = pc.fill_null(pc.index_in(names, value_set=self.table.parts), -1).to_numpy()
        known = at >= 0
        tokens[known] = self.table.tokens[at[known]]
        self.seen["table"] += int(known.sum())
        firsts = offsets[:-1]
        # What only begins texts is not looked up as a part that follows a space.
        follows = np.ones(len(index), bool)
        follows[firsts] = False
        used = np.zeros(len(names), bool)
        used[index[follows]] = True
        missing = np.flatnonzero(~known & used)
        for i, part in zip(missing, names.take(pa.array(missing)).to_pylist(), strict=True):
            tokens[i] = self._remembered(self.memory, part, self.own.part)
        each = tokens[index]
        each[firsts] = [self._remembered(self.firsts, p, self.own.first) if p else 0 for p in names.take(pa.array(index[firsts])).to_pylist()]
        return np.add.reduceat(each, firsts) if len(texts) else np.empty(0, np.int64)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; NULL is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        whole = np.full(n, not self.own.parted)
        for s in self.own.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        found = np.zeros(n, np.int64)
        for i in np.flatnonzero(whole):
            found[i] = self.own.whole(texts[int(i)].as_py())
        rest = np.flatnonzero(~whole)
        sizes = pc.binary_length(texts).to_numpy()[rest]
        groups = np.cumsum(sizes) // BATCH_BYTES
        for group in np.unique(groups):
            here = rest[groups == group]
            found[here] = self.parted(texts.take(pa.array(here)))
        return found


_COUNTS: dict[tuple, Counts] = {}


def _counts(vocabulary: str, table) -> Counts:
    """One per worker process, vocabulary and table."""
    key = (vocabulary, table.id if hasattr(table, "id") else id(table))
    if key not in _COUNTS:
        _COUNTS.clear()
        _COUNTS[key] = Counts(vocabulary, table.value)
    return _COUNTS[key]


_RESULT, _RESULT_DDL = arrow_schema(doc_id="long", n_bytes="long", n_tokens="long", over_limit="boolean")


def _count_batches(batches, vocabulary: str, table, limit: int):
    counts = _counts(vocabulary, table)
    for batch in batches:
        text = pc.fill_null(batch.column(1).cast(pa.string()), "")
        tokens = counts(text)
        columns = [batch.column(0).cast(pa.int64()), pc.binary_length(text).cast(pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)]
        yield pa.RecordBatch.from_arrays(columns, schema=_RESULT)
        pa.default_memory_pool().release_unused()


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", table: Table | None = None
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Tokens are those of the vocabulary's library for the whole text, without begin, end or added special tokens;
    special strings inside texts are handled as it does. NULL counts as empty: 0 bytes, 0 tokens; NULL ids and
    repeated rows stay as they are, one row each; other columns are ignored; an empty table gives no rows. A
    vocabulary that is not byte-level has no table, and its texts are encoded whole.
    """
    table = fit_table(docs, vocabulary, text_col) if table is None else table
    shared = docs.sparkSession.sparkContext.broadcast(table)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(partial(_count_batches, vocabulary=vocabulary, table=shared, limit=limit), _RESULT_DDL)
