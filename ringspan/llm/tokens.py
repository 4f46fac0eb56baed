"""Token ids of whole texts, encoded inside tasks with the tokenizers library.

The vocabulary's byte-level pre-tokenizer always starts a new unit at a space that is followed by
something other than white space, and units are encoded independently. So a text may be cut at those
spaces, each distinct piece of a batch encoded once, and the ids put in order again: the result is
that of encoding the whole text, in a fraction of the time. Texts that hold one of the vocabulary's
special strings, or a space before more white space, are encoded whole, and so is every text when the
vocabulary is of another kind.
"""

from __future__ import annotations

import json
import os
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text characters handled at once.
BATCH_CHARS = 6_000_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file; files are read where they are installed, never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> str:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return "".join(letters[b] for b in range(256))


_ALNUM = np.array([chr(b).isalnum() for b in range(128)] + [False] * 128)
_BLANK = np.array([chr(b).isspace() for b in range(128)] + [False] * 128)


def _edges(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the last character is a letter or digit, the text is empty or starts with white space) of each text."""
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    empty = offsets[1:] == offsets[:-1]
    first, last = np.zeros(len(words), np.uint8), np.zeros(len(words), np.uint8)
    first[~empty], last[~empty] = data[offsets[:-1][~empty]], data[offsets[1:][~empty] - 1]
    ends_well, blank = _ALNUM[last], _BLANK[first] | empty
    for edge, found, at in ((last, ends_well, -1), (first, blank, 0)):
        wide = np.flatnonzero(edge >= 128)
        for i, w in zip(wide, words.take(pa.array(wide)).to_pylist(), strict=True):
            found[i] = w[at].isalnum() if at else w[0].isspace()
    ends_well[empty] = False
    return ends_well, blank


def _gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[begin : begin + size] of the entries ``at`` one behind the other, and where each ends."""
    each = size[at]
    ends = np.cumsum(each, dtype=np.int32)
    taken = np.repeat(begin[at] - (ends - each), each)
    taken += np.arange(len(taken), dtype=np.int32)
    return flat[taken], ends


class Encoder:
    """Encodes texts to ids; ``remembered`` bounds the pieces a worker process knows."""

    def __init__(self, path: str, remembered: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            model = json.load(source)
        self.special = [t["content"] for t in model.get("added_tokens") or ()]
        before = model.get("pre_tokenizer") or {}
        self.cuts = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not model.get("normalizer") and not (model.get("model") or {}).get("dropout")
        )
        self.letters = _byte_letters()
        self.space = self.letters[32]
        # What pieces seen so far encode to: their ids are flat[begin : begin + size]; uses decide what stays.
        self.remembered, self.tails, self.parts = remembered, {}, {}
        self.known, self.flat = pa.array([], pa.large_string()), np.empty(0, "<u4")
        self.begin, self.size, self.uses = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32)

    def whole(self, text: str) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers."""
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(unit)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece that follows a space."""
        if not piece or piece[0].isspace():
            return b""
        if piece.isalpha() and (piece.isascii() or max(piece) < "\u0250"):
            # Letters with the space before them are one unit.
            return self._unit(self.space + (piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])))
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(" " + piece)
        parts = self.parts
        if len(parts) > 150_000:
            parts.clear()
        for unit, _ in cut:
            if unit not in parts:
                parts[unit] = self._unit(unit)
        return b"".join([parts[unit] for unit, _ in cut])

    def _forget(self) -> None:
        """Keep the pieces that more than one batch had, if those are not too many either."""
        stay = np.flatnonzero(self.uses > 1) if (self.uses > 1).sum() <= self.remembered // 2 else np.empty(0, np.int64)
        size = self.size[stay]
        ends = np.cumsum(size, dtype=np.int32)
        taken = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(self.begin[stay] - (ends - size), size)
        self.flat, self.known = self.flat[taken], self.known.take(pa.array(stay))
        self.begin, self.size, self.uses = ends - size, size, np.ones(len(stay), np.int32)

    def _learn(self, names: list[str], ids: list[bytes]) -> np.ndarray:
        """Places of new pieces."""
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        first, base = len(self.size), len(self.flat)
        self.begin = np.concatenate([self.begin, base + np.cumsum(size, dtype=np.int32) - size])
        self.size, self.uses = np.concatenate([self.size, size]), np.concatenate([self.uses, np.zeros(len(ids), np.int32)])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        self.known = pa.concat_arrays([self.known, pa.array(names, pa.large_string())])
        return np.arange(first, first + len(ids), dtype=np.int32)

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of pieces that follow a space are, learning those not seen."""
        if len(self.known) > self.remembered:
            self._forget()
        at = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy().astype(np.int32)
        missing = np.flatnonzero(at < 0)
        names, space, tokenize = pieces.take(pa.array(missing)).to_pylist(), self.space, self.tokenizer.model.tokenize
        at[missing] = self._learn(names, [
            array("I", [t.id for t in tokenize(space + p)]).tobytes() if p.isascii() and p.isalpha() else self._piece(p) for p in names
        ])
        self.uses[at] += 1
        return at

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and for each text where its ids start (one number more than texts). NULL is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        if not self.cuts:
            found = [np.frombuffer(self.whole(t), "<u4") for t in texts.to_pylist()]
            return np.concatenate([np.empty(0, "<u4"), *found]), np.cumsum([0, *map(len, found)])
        special = np.zeros(n, bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        index, names = coded.indices.to_numpy(), coded.dictionary
        firsts = offsets[:-1] - offsets[0]
        index = index[: offsets[-1] - offsets[0]]

        # Marks behind a letter or digit are a unit of their own: most pieces are one of fewer words and a tail.
        trimmed = pc.utf8_rtrim(names, string.punctuation)
        words = trimmed.dictionary_encode()
        word = words.indices.to_numpy()
        ends_well, odd = (x[word] for x in _edges(words.dictionary))
        marked = (pc.binary_length(names).to_numpy() > pc.binary_length(trimmed).to_numpy())
        cut, full = np.flatnonzero(marked & ends_well), np.flatnonzero(marked & ~ends_well)
        odd[full] = _edges(names.take(pa.array(full)))[1]
        tail_names = [t[len(t.rstrip(string.punctuation)):] for t in names.take(pa.array(cut)).to_pylist()]
        own_tails = list(set(tail_names))
        for t in own_tails:
            if t not in self.tails:
                self.tails[t] = self._unit("".join([self.letters[b] for b in t.encode()]))

        places = self._places(pa.concat_arrays([words.dictionary, names.take(pa.array(full))]))
        body = places[word]
        body[full] = places[len(words.dictionary):]
        nothing, known = len(self.size), len(self.flat)
        ids = [b"", *(self.tails[t] for t in own_tails)]
        if len(self.tails) > 100_000:
            self.tails.clear()
        tail, tail_index = np.full(len(names), nothing, np.int32), {t: nothing + 1 + i for i, t in enumerate(own_tails)}
        tail[cut] = [tail_index[t] for t in tail_names]
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        begin = np.concatenate([self.begin, known + np.cumsum(size, dtype=np.int32) - size])
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        of_names, ends = _gathered(flat, begin, np.concatenate([self.size, size]), np.stack([body, tail], 1).ravel())
        ends = np.concatenate([[0], ends[1::2]]).astype(np.int32)

        # The first piece of a text follows no space; a text to be encoded whole is one such piece.
        whole = special
        if odd.any():
            inside = odd[index]
            inside[firsts] = False
            whole = whole | (np.add.reduceat(inside, firsts) > 0)
        alone = [self.whole(p) if p else b"" for p in names.take(pa.array(index[firsts])).to_pylist()]
        for i in np.flatnonzero(whole):
            alone[i] = self.whole(texts[int(i)].as_py())
        size = np.fromiter(map(len, alone), np.int32, n) // 4
        begin = np.concatenate([ends[:-1], len(of_names) + np.cumsum(size, dtype=np.int32) - size, [0]]).astype(np.int32)
        size = np.concatenate([np.diff(ends), size, [0]]).astype(np.int32)
        index = index.astype(np.int32)
        if whole.any():
            index[np.repeat(whole, np.diff(offsets))] = len(size) - 1
        index[firsts] = len(names) + np.arange(n, dtype=np.int32)
        flat = np.concatenate([of_names, np.frombuffer(b"".join(alone), "<u4")])
        taken, ends = _gathered(flat, begin, size, index)
        pa.default_memory_pool().release_unused()
        return taken, np.concatenate([[0], ends])[offsets - offsets[0]]

    def documents(self, texts: pa.Array, end_id: int | None = None):
        """For each text its ids as an array, with ``end_id`` behind them if given."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        tail = np.empty(0, "<u4") if end_id is None else np.array([end_id], "<u4")
        at = 0
        while at < len(texts):
            base = sizes[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(sizes, base + BATCH_CHARS, "right")))
            ids, starts = self.batch(texts.slice(at, upto - at))
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                yield np.concatenate([ids[a:b], tail])
            at = upto


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
