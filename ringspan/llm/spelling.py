"""Spelling variants by finite-state composition.

The vocabulary is a minimised acceptor. Composed with a transducer that makes exactly one edit, and with the acceptor
again, it accepts the pairs of words that differ by one inserted, deleted or replaced code point. The composition is
enumerated in parts by the state its paths begin in, the one behind the first code points of a word:

* a part holds the words of one beginning, and gives the pairs whose first difference lies behind it;
* a part with many words is opened: its words are dealt by a longer beginning, and the pairs whose first difference
  lies within the code points added are found in parts of their own, keyed by what follows these.

Every pair is accepted along one path only, with the edit at the first difference, and in one part only, so counts are
sums. A part gives one row per word: the number of its near words and the best one, not the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import arrow_schema

#: Distinct words a task holds before it hands them on.
HELD = 400_000
#: Code points by which a beginning grows, and the words up to which a part is not opened.
GROWTH, PART_WORDS = 3, 4_000

_COUNT, _COUNT_DDL = arrow_schema(word="string", n="long")
_NEAR, _NEAR_DDL = arrow_schema(word="string", near="long", best_n="long", best="string")


def document_words(doc_id: int | None, text: bytes, least: int, every: int) -> Counter:
    """The words of a text of at least ``least`` code points, counted.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Where ``every`` divides the crc32
    of ``<doc_id>:<word>``, the code point at that number modulo the word's length is left out.
    """
    runs = Counter(re.findall(f"[a-zÀ-ÿ]{{{least},}}", text.lower().decode(errors="replace")))
    ahead, changed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id), []
    for word in runs:
        h = zlib.crc32(word.encode(), ahead)
        if h % every == 0:
            changed.append((word, h % len(word)))
    moved = [(word[:at] + word[at + 1 :], runs.pop(word)) for word, at in changed]
    for word, n in moved:
        if len(word) >= least:
            runs[word] += n
    return runs


def _count_words(batches, least: int, every: int):
    held: Counter = Counter()
    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.string()), "").cast(pa.binary()).to_pylist()
        for doc_id, text in zip(batch.column(0).cast(pa.int64()).to_pylist(), texts, strict=True):
            held.update(document_words(doc_id, text, least, every))
            if len(held) > HELD:
                yield _counted(held)
                held = Counter()
    yield _counted(held)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=_COUNT)


class Acceptor:
    """The minimal deterministic acceptor of sorted distinct words; states are numbers, 0 the one they begin in."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        register: dict[tuple, int] = {}
        path: list[tuple[int, str]] = []  # (state, symbol behind it) of the last word, not yet merged

        def settle(down_to: int) -> None:
            while len(path) > down_to:
                state, symbol = path.pop()
                after = self.arcs[state][symbol]
                known = register.setdefault((self.final[after], *self.arcs[after].items()), after)
                self.arcs[state][symbol] = known

        last = ""
        for word in words:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            settle(same)
            state = self.arcs[path[-1][0]][path[-1][1]] if path else 0
            for symbol in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[state][symbol] = len(self.arcs) - 1
                path.append((state, symbol))
                state = len(self.arcs) - 1
            self.final[state] = True
            last = word
        settle(0)


class Composition:
    """Acceptor, one-edit transducer, acceptor: the pairs (shorter or smaller, other) that differ by one edit."""

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self.common: dict[tuple[int, int], list[str]] = {}

    def language(self, p: int) -> list[str]:
        """Everything that leads from a state to an accepted end."""
        known = self.common.get((p, p))
        if known is None:
            known, todo = [], [("", p)]
            while todo:
                start, state = todo.pop()
                chain, state = self.chain(state)
                start += chain
                if self.final[state]:
                    known.append(start)
                todo += [(start + symbol, after) for symbol, after in self.arcs[state].items()]
            self.common[p, p] = known
        return known

    def chain(self, state: int) -> tuple[str, int]:
        """The symbols up to the first state that is an end or parts ways, and that state."""
        symbols: list[str] = []
        while not self.final[state] and len(self.arcs[state]) == 1:
            ((symbol, state),) = self.arcs[state].items()
            symbols.append(symbol)
        return "".join(symbols), state

    def rests(self, p: int, q: int) -> list[str]:
        """What leads from both states to an accepted end, once for every pair of states."""
        if p == q:
            return self.language(p)
        todo = [(p, q)]
        while todo:
            here = todo[-1]
            if here in self.common:
                todo.pop()
                continue
            a, b = (self.arcs[s] for s in here)
            both = [(symbol, (after, b[symbol])) for symbol, after in a.items() if symbol in b]
            for _, (x, y) in both:
                if x == y:
                    self.language(x)
            missing = [pair for _, pair in both if pair not in self.common]
            if missing:
                todo += missing
                continue
            known = [""] if self.final[here[0]] and self.final[here[1]] else []
            for symbol, pair in both:
                known += [symbol + rest for rest in self.common[pair]]
            self.common[here] = known
        return self.common[p, q]

    def pairs(self, upto: int | None = None):
        """All pairs whose first difference lies before place ``upto`` of the words."""
        todo = [("", 0)]
        while todo:
            start, p = todo.pop()
            chain, p = self.chain(p)  # no edit on a chain makes another word
            start += chain
            if upto is not None and len(start) >= upto:
                continue
            out = list(self.arcs[p].items())
            for i, (b, after) in enumerate(out):
                for c, other in out[:i]:
                    for rest in self.rests(after, other):
                        yield start + c + rest, start + b + rest
                # One more code point b here: what follows must not begin with it, or the words differ later.
                if self.final[p] and self.final[after]:
                    yield start, start + b
                further = self.arcs[after]
                for c, other in out:
                    if c != b and c in further:
                        for rest in self.rests(other, further[c]):
                            yield start + c + rest, start + b + c + rest
            todo += [(start + symbol, after) for symbol, after in out]


def _compose(batches):
    """Per part: its words' near words within it, counted, and the best of them."""
    for batch in batches:
        out: dict[str, list] = {"word": [], "near": [], "best_n": [], "best": []}
        for i in range(len(batch)):
            (row,) = batch.slice(i, 1).to_pylist()
            cut, rest, upto = row["cut"], row["rest"], row["upto"]
            counts = {w["word"][cut:]: w["n"] for w in row["words"]}
            start, found = row["words"][0]["word"][:cut], {}
            longest = None if rest is None else rest + GROWTH
            for u, v in Composition(Acceptor(sorted(counts))).pairs(upto):
                # Words as long as the longer one of a pair are there for pairs with shorter ones only.
                if longest is not None and len(u) > longest:
                    continue
                for a, b in ((u, v), (v, u)):
                    near, best = found.get(a, (0, None))
                    key = (-counts[b], b)
                    found[a] = (near + 1, key if best is None or key < best else best)
            for word, (near, best) in found.items():
                out["word"].append(start + word)
                out["near"].append(near)
                out["best_n"].append(-best[0])
                out["best"].append(start + best[1])
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _NEAR], schema=_NEAR)


def near_words(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(word, near, best_n, best): per word and part the number of near words and the one of largest ``n``.

    ``words`` are stored distinct (word, n). Opening goes on until every part is small, one pass over the words of
    the opened parts each.
    """
    held, cut, found = words, 0, None
    while True:
        # The words behind a beginning of ``cut`` code points, to be opened.
        key = lambda skip: F.struct(
            F.substring("word", skip + 1, 1 << 30).alias("rest"), F.substring("word", 1, cut).alias("start")
        )
        longer = F.when(F.length("word") > cut + GROWTH, key(cut + GROWTH + 1))
        keys = F.array_compact(F.array(key(cut + GROWTH), longer))
        within = held.select("word", "n", F.explode(keys).alias("key")).groupBy("key").agg(F.collect_list(F.struct("word", "n")).alias("words"))
        within = within.filter(F.size("words") > 1).select(
            F.lit(cut).alias("cut"), F.length("key.rest").alias("rest"), F.lit(GROWTH).alias("upto"), "words"
        )
        cut += GROWTH
        starts = held.filter(F.length("word") >= cut).withColumn("start", F.substring("word", 1, cut))
        sizes = starts.groupBy("start").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sizes = store(sizes, "spelling-parts")
        small = starts.join(sizes.filter(F.col("size") <= part_words), "start").groupBy("start").agg(F.collect_list(F.struct("word", "n")).alias("words"))
        behind = small.select(F.lit(cut).alias("cut"), F.lit(None).cast("int").alias("rest"), F.lit(None).cast("int").alias("upto"), "words")
        parts = within.unionByName(behind).mapInArrow(_compose, _NEAR_DDL)
        found = parts if found is None else found.unionByName(parts)
        large = sizes.filter(F.col("size") > part_words)
        if large.isEmpty():
            return found
        held = store(starts.join(large, "start", "left_semi").select("word", "n"), "spelling-words")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form that each word with a form leads to, by pointer doubling.

    A form has several times the occurrences of its word, so chains are short and end.
    """
    state = store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        jump = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = state.join(jump, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = store(moved, "spelling-roots")
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def vocabulary(docs: DataFrame, least: int = 6, often: int = 5, every: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored (word, n): the words of all texts with at least ``least`` code points and ``often`` occurrences."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = rows.mapInArrow(partial(_count_words, least=least, every=every), _COUNT_DDL)
    return store(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often), "spelling-vocabulary")


def spelling_variants(
    docs: DataFrame, least: int = 6, often: int = 5, factor: int = 5, every: int = 199, id_col: str = "doc_id", text_col: str = "text",
    part_words: int = PART_WORDS,
) -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n.

    Words are near if they differ by one code point; the form is the near word of largest ``n`` (ties: the smallest in
    code-point order) if it has ``factor`` times the word's ``n`` or more; the root is where forms lead. NULL and
    empty texts hold no words; a NULL id counts as an empty one in the hash; repeated rows count again; other columns
    are ignored; an empty table, or one without frequent words, gives no rows.
    """
    words = vocabulary(docs, least, often, every, id_col, text_col)
    near = near_words(words, part_words).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("first")
    )
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.col("first.best").alias("best"), (-F.col("first.rank")).alias("best_n")
    )
    formed = F.col("best_n") >= factor * F.col("n")
    judged = store(
        joined.select("word", "n", "n_near", F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "spelling-forms"
    )
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
