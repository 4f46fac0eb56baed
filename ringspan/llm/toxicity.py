"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

A text is cut into windows, its words in lower case with a blank on each side. A window's distance is its
compressed length under the ordinary dictionary less that under the toxic one. How many windows reach each of a
row of distances, and how many windows there are, make the score by a calibrated logistic curve.

Both dictionaries are fitted on a bounded sample of labelled rows. Toxic documents are mostly ordinary text, so the
toxic dictionary is made of their windows with letter runs that toxic documents hold far more often than ordinary
ones; the ordinary dictionary has the commonest ordinary windows. Windows are short, so each byte is written as a
fixed code of ``CODE`` bytes before compression: else the format's own overhead hides a match.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

CODE = 3
#: Longer words are cut into windows of this many bytes that overlap by OVERLAP.
LONGEST, OVERLAP = 40, 12
STEPS = np.arange(2, 28, 2)

_LETTERS = {*range(65, 91), *range(97, 123), *range(128, 256)}
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b in _LETTERS else 32 for b in range(256))
_CODES = [hashlib.md5(bytes([b])).digest()[:CODE] for b in range(256)]


def windows(text: bytes) -> list[bytes]:
    """The words of a text in lower case, long ones in overlapping pieces."""
    words = text.translate(_PLAIN).split()
    if not words or len(max(words, key=len)) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, max(1, len(w) - OVERLAP), LONGEST - OVERLAP)]


def _coded(window: bytes) -> bytes:
    return b"".join([_CODES[b] for b in b" " + window + b" "])


@dataclass
class Model:
    """What scoring needs: the contents of both dictionaries and the curve."""

    toxic: bytes
    ordinary: bytes
    level: int = 12
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


class Scorer:
    """Scores texts; distances of windows seen are remembered, ``remembered`` at most."""

    def __init__(self, model: Model, remembered: int = 400_000):
        self.model, self.remembered, self.known = model, remembered, {}
        settings = zstandard.ZstdCompressionParameters.from_level(
            model.level, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0
        )

        def lengths(content: bytes):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(dict_data=data, compression_params=settings).compress

        self.as_toxic, self.as_ordinary = lengths(model.toxic), lengths(model.ordinary)

    def distances(self, text: bytes) -> np.ndarray:
        """Of each window the length as ordinary text less the length as toxic text."""
        found = windows(text)
        known = self.known
        distances = list(map(known.get, found))
        if None in distances:
            if len(known) > self.remembered:
                known.clear()
            for w in found:
                if w not in known:
                    coded = _coded(w)
                    known[w] = len(self.as_ordinary(coded)) - len(self.as_toxic(coded))
            distances = [known[w] for w in found]
        return np.array(distances, np.int64)

    def features(self, text: bytes) -> np.ndarray:
        distances = self.distances(text)
        reach = (len(distances) - np.searchsorted(np.sort(distances), STEPS)).astype(float)
        share = 1000 * reach / max(len(distances), 20)
        return np.concatenate([np.log1p(reach), np.minimum(reach, 1), np.log1p(share), [np.log1p(len(distances))]])

    def score(self, text: bytes) -> float:
        m = self.model
        x = np.append((self.features(text) - m.centre) / m.spread, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ m.weights, -30, 30))))


def _document_counts(texts: list[bytes], run: int) -> Counter:
    found: Counter = Counter()
    for t in texts:
        t = b" " + b" ".join(windows(t)) + b" "
        found.update({t[i : i + run] for i in range(len(t) - run + 1)})
    return found


def _contents(toxic: list[bytes], ordinary: list[bytes], run: int, times: float, least: int, kept: tuple[int, int]):
    """The contents of both dictionaries: windows coded, the commonest last, where offsets are short."""
    a, b = _document_counts(toxic, run), _document_counts(ordinary, run)
    least = max(least, len(toxic) // 200)
    marks = {g for g, n in a.items() if n >= least and n / len(toxic) >= times * (b[g] + 1) / len(ordinary)}

    def marked(w: bytes) -> bool:
        w = b" " + w + b" "
        return any(w[i : i + run] in marks for i in range(len(w) - run + 1))

    common = Counter(w for t in toxic for w in windows(t) if marked(w))
    usual = Counter(w for t in ordinary for w in windows(t))
    content = lambda c, n: b"".join(_coded(w) for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:n][::-1])
    return content(common, kept[0]), content(usual, kept[1])


def _curve(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 25):
    """Logistic weights by Newton's method with a quadratic penalty."""
    centre, spread = x.mean(0), x.std(0) + 1e-6
    z = np.c_[(x - centre) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(w)), z.T @ (p - y) + penalty * w)
    return centre, spread, w


def held_out(doc_id: int | None) -> bool:
    """Whether labels of this document are never learnt."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def fit(
    docs: DataFrame, labels: DataFrame, toxic_docs: int = 2000, ordinary_docs: int = 8000, sample_chars: int = 20_000,
    run: int = 5, times: float = 5.0, least: int = 5, kept: tuple[int, int] = (1500, 4000), id_col: str = "doc_id",
    text_col: str = "text",
) -> Model | None:
    """Fit on at most ``toxic_docs`` toxic and ``ordinary_docs`` ordinary labelled rows, picked by a hash of their id.

    Rows whose crc32(doc_id as text) mod 5 is 0 are never used. Of a sampled text the first ``sample_chars``
    characters are learnt; scoring always reads whole texts. A part of
    the sample fills the dictionaries and the rest calibrates. None if either class has no row.
    """
    own = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(own)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda value, n: known.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    # The sample's size bounds what is broadcast and what the driver gets.
    sample = pick(1, toxic_docs).unionByName(pick(0, ordinary_docs))
    text = F.substring(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 1, sample_chars)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(sample), "doc_id")
    by_class: dict[int, dict[int, bytes]] = {0: {}, 1: {}}
    for r in rows.collect():
        by_class[r["toxic"]][r["doc_id"]] = max(r["text"].encode(), by_class[r["toxic"]].get(r["doc_id"], b""))
    toxic, ordinary = ([texts[k] for k in sorted(texts, key=lambda k: (zlib.crc32(str(k).encode()), k))] for texts in (by_class[1], by_class[0]))
    if not toxic or not ordinary:
        return None
    return fit_texts(toxic, ordinary, run, times, least, kept)


def fit_texts(
    toxic: list[bytes], ordinary: list[bytes], run: int = 5, times: float = 5.0, least: int = 5, kept: tuple[int, int] = (1500, 4000)
) -> Model:
    """Dictionaries from one part of the texts, the curve from the other; equal texts count once."""
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    a, b = -(-2 * len(toxic) // 3), -(-len(ordinary) // 2)
    model = Model(*_contents(toxic[:a], ordinary[:b], run, times, least, kept))
    scorer = Scorer(model)
    calibrate = [(t, 1.0) for t in toxic[a:] or toxic] + [(t, 0.0) for t in ordinary[b:] or ordinary]
    x = np.array([scorer.features(t) for t, _ in calibrate])
    model.centre, model.spread, model.weights = _curve(x, np.array([y for _, y in calibrate]))
    return model


def _score(batches, model: Model | None, text_at: int, keep: list[int], names: list[str]):
    scorer = Scorer(model) if model else None
    for batch in batches:
        text = pc.fill_null(batch.column(text_at).cast(pa.string()), "").cast(pa.binary())
        scores = [scorer.score(t) if scorer else 0.0 for t in text.to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(scores, pa.float64())], names=names)


def _scored(docs: DataFrame, model: Model | None, text_col: str, keep_text: bool) -> tuple[DataFrame, str]:
    score = fresh("toxic_score", docs.columns)
    keep = [i for i, c in enumerate(docs.columns) if keep_text or c != text_col]
    schema = T.StructType([docs.schema.fields[i] for i in keep] + [T.StructField(score, T.DoubleType())])
    run = partial(_score, model=model, text_at=docs.columns.index(text_col), keep=keep, names=schema.names)
    return docs.mapInArrow(run, schema), score


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Whole texts are read; NULL and empty ones have no windows and get the curve's score for that. Without a model
    every score is 0. Repeated rows are scored each; a NULL id counts as held out; other columns are ignored.
    """
    rows, score = _scored(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), model, "text", False)
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))
    return rows.select("doc_id", out.alias("held_out"), F.col(score).alias("score"), (F.col(score) >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, all columns unchanged."""
    rows, score = _scored(docs, model, text_col, True)
    return rows.filter(F.col(score) < threshold).select(*[f"`{c}`" for c in docs.columns])
