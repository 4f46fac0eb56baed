"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks. Each block becomes a vector of its tag path (hashed tags, class and id words, and
whether the nearest telling ancestor is article or surroundings), its hashed words and some counts. A bidirectional
LSTM in numpy reads the whole sequence of a page and says of every block whether it is main text.

The network is trained on blocks of a bounded sample of pages with weak labels from their markup, varied so that it
does not hang on one layout: containers are renamed, markup is stripped, and blocks of other pages are put in as
sidebars, notices, adverts, forms and comments.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema

#: Elements whose content is never text of the page: those without markup inside, which run to the end if unclosed,
RAW = ("script", "style", "textarea", "title")
#: and those that are dropped where they are closed. An unclosed one is passed over as a tag, and what follows is read.
DROPPED = ("noscript", "template", "svg", "iframe", "object", "select", "button", "canvas")
BLOCKS = frozenset(
    "html body head div section article main nav header footer aside ul ol li dl dt dd table thead tbody tfoot tr td th caption form "
    "fieldset p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary hr center legend".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
#: A new one of these ends an open one of the same kind.
SELF_ENDING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Blocks that cannot stand in a paragraph and so end it.
ENDS_P = BLOCKS - {"html", "body", "head"}
SURROUNDINGS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar banner footer foot copyright sidebar aside widget widgets "
    "related recommended recommendations popular trending share sharing social follow subscribe subscription newsletter signup login "
    "search form cookie cookies consent gdpr notice notices notification alert popup modal overlay ad ads adv advert adverts "
    "advertisement advertising adsense sponsor sponsored promo promotion promoted comment comments reply replies disqus discussion "
    "respond pagination pager toolbar skip hidden disclaimer outbrain taboola".split()
)
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT_WORDS = frozenset("article main content post entry story body text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?/][^>]*>|[^<]+|<",
    re.S | re.I,
)
_DROPS = re.compile(r"<(?:" + "|".join(DROPPED) + r")[\s/>]", re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    """A leaf: its ancestors as (tag, words of class, id and role), its text and how many characters are links."""

    path: tuple
    text: str
    linked: int


def _words_of(tag: str, attributes: str) -> tuple:
    if not attributes or tag in ("html", "body"):
        return ()
    found = [w for m in _ATTRIBUTE.finditer(attributes) for w in _WORDS.findall((m[2] or m[3] or m[4] or "").lower())]
    return (*found, "hidden") if _HIDDEN.search(attributes) else tuple(found)


def _dropped(tokens: list[re.Match]) -> dict[int, int]:
    """Of each closed element to drop the places of its tags."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for i, m in enumerate(tokens):
        tag = (m[3] or m[6] or "").lower()
        if tag not in DROPPED:
            continue
        if m[2] or m[5]:
            if opened.get(tag):
                ends[opened[tag].pop()] = i
        elif tag in ("button", "select"):
            opened[tag] = [i]  # these do not nest
        elif tag != "svg" or not (m[4] or m[7] or "").rstrip().endswith("/"):
            opened.setdefault(tag, []).append(i)
    return ends


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; character references decoded, white space single."""
    found: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    text: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = "".join(text)
            if "&" in joined:
                joined = entities.unescape(joined)
            joined = " ".join(joined.split())
            if joined:
                found.append(Block(tuple(stack), joined, linked))
            text.clear()
        linked = 0

    page = page or ""
    tokens = list(_TOKEN.finditer(page))
    ends = _dropped(tokens) if _DROPS.search(page) else {}
    upto = -1
    for i, m in enumerate(tokens):
        if i <= upto:
            continue
        if i in ends:
            upto = ends[i]
            text.append(" ")
            continue
        tag = m[3] or m[6]
        if tag is None:
            part = m[0]
            if part[0] != "<" or part == "<":
                text.append(part)
                if links:
                    linked += len(part.strip())
            elif m[1]:
                text.append(" ")
            continue
        closing, tag = m[2] or m[5], tag.lower()
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCKS:
            flush()
            if closing:
                names = [t for t, _ in stack]
                if tag in names:
                    del stack[len(names) - 1 - names[::-1].index(tag):]
            else:
                if stack and stack[-1][0] == "p" and tag in ENDS_P:
                    stack.pop()
                while stack and stack[-1][0] in SELF_ENDING.get(tag, ()):
                    stack.pop()
                if tag not in VOID:
                    stack.append((tag, _words_of(tag, m[4] or m[7] or "")))
    flush()
    return found


def standing(path: tuple) -> tuple[int, int, int]:
    """(in surroundings, in an article, in a container named like content) by the nearest telling ancestor."""
    named = 0
    heading = False
    for tag, words in reversed(path):
        heading = heading or tag in ("h1", "h2")
        if tag == "header" and heading and any(t in CONTENT_TAGS for t, _ in path):
            continue
        if tag in SURROUNDINGS or any(w in SURROUNDINGS for w in words):
            return 1, 0, 0
        if tag in CONTENT_TAGS:
            return 0, 1, 0
        named = named or int(any(w in CONTENT_WORDS for w in words))
    return 0, 0, named


def weak_labels(blocks: list[Block]) -> np.ndarray:
    """Which blocks the markup alone takes for main text."""
    where = [standing(b.path) for b in blocks]
    for kind in (1, 2):
        if any(w[kind] for w in where):
            return np.array([w[kind] for w in where], float)
    return np.array([float(not w[0] and 2 * b.linked <= len(b.text)) for w, b in zip(where, blocks, strict=True)])


PATHS, WORDS, LEAVES = 24, 16, ("p", "h1", "h2", "h3", "li", "td", "div", "pre", "blockquote")
INPUT = PATHS + WORDS + len(LEAVES) + 12
_SIGNS = re.compile(r"[.,;:!?]")


def vectors(blocks: list[Block], known: dict[str, int]) -> np.ndarray:
    """One row per block. ``known`` remembers the bucket of words seen."""
    n = len(blocks)
    out = np.zeros((n, INPUT))
    paths: dict[tuple, tuple] = {}
    for i, b in enumerate(blocks):
        if b.path not in paths:
            names = [x for tag, words in b.path for x in (tag, *words)]
            at = [zlib.crc32(x.encode()) % PATHS for x in names]
            leaf = next((t for t, _ in reversed(b.path) if t in LEAVES), None)
            paths[b.path] = (at, LEAVES.index(leaf) if leaf else -1, standing(b.path), len(b.path))
        at, leaf, where, depth = paths[b.path]
        row = out[i]
        row[at] = 1.0
        words = b.text.split()
        buckets = []
        for w in words:
            k = known.get(w)
            if k is None:
                if len(known) > 300_000:
                    known.clear()
                k = known[w] = zlib.crc32(w.lower().encode()) % WORDS
            buckets.append(k)
        counts = np.bincount(buckets, minlength=WORDS)
        row[PATHS : PATHS + WORDS] = counts / max(1.0, np.sqrt(counts @ counts))
        if leaf >= 0:
            row[PATHS + WORDS + leaf] = 1.0
        size = len(b.text)
        row[-12:] = (
            3 * where[0], 3 * where[1], 3 * where[2], np.log1p(size) / 5, np.log1p(len(words)) / 4, b.linked / size,
            len(_SIGNS.findall(b.text[-400:])) / max(1, min(size, 400)) * 10, b.text[-1] in ".!?", depth / 8, i / n, i == 0, i == n - 1,
        )
    return out


@dataclass
class Labeller:
    """A bidirectional LSTM with one logistic output per step."""

    hidden: int = 16
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, hidden: int, seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w[f"x{side}"] = rng.normal(0, 1 / np.sqrt(INPUT), (INPUT, 4 * hidden))
            w[f"h{side}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            w[f"c{side}"] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)])  # open forget gates
        w["out"], w["skip"], w["bias"] = rng.normal(0, 0.1, 2 * hidden), np.zeros(INPUT), np.zeros(1)
        return cls(hidden, w)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None):
        """States of one direction: x (steps, pages, INPUT), mask (steps, pages). Padded steps carry the state on."""
        w, n = self.weights, self.hidden
        steps, pages = mask.shape
        given = x @ w[f"x{side}"] + w[f"c{side}"]
        h, c, out = np.zeros((pages, n)), np.zeros((pages, n)), np.zeros((steps, pages, n))
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            gates = given[t] + h @ w[f"h{side}"]
            s = 1 / (1 + np.exp(-gates[:, : 3 * n]))
            g, m = np.tanh(gates[:, 3 * n :]), mask[t][:, None]
            new = s[:, :n] * c + s[:, n : 2 * n] * g
            tanh = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, s, g, tanh))
            c = np.where(m, new, c)
            h = np.where(m, s[:, 2 * n :] * tanh, h)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        both = [self._run(x, mask, side, keep.setdefault(side, []) if keep is not None else None) for side in "fb"]
        states = np.concatenate(both, axis=2)
        if keep is not None:
            keep["states"] = states
        return states @ self.weights["out"] + x @ self.weights["skip"] + self.weights["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the real steps and its gradients, back through time."""
        keep: dict = {}
        z = self.logits(x, mask, keep)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        total = mask.sum()
        loss = -(np.log(np.where(y > 0.5, p, 1 - p) + 1e-12) * mask).sum() / total
        d = (p - y) * mask / total
        w, n, out = self.weights, self.hidden, {}
        out["out"] = np.einsum("tp,tpk->k", d, keep["states"])
        out["skip"], out["bias"] = np.einsum("tp,tpk->k", d, x), np.array([d.sum()])
        for k, side in enumerate("fb"):
            own = w["out"][k * n : (k + 1) * n]
            dgiven, dh, dc = np.zeros((*mask.shape, 4 * n)), np.zeros((mask.shape[1], n)), np.zeros((mask.shape[1], n))
            grad_h = np.zeros_like(w[f"h{side}"])
            for t, h, c, s, g, tanh in reversed(keep[side]):
                m = mask[t][:, None]
                dh = dh + d[t][:, None] * own
                live = np.where(m, dh, 0)
                forget, enter, leave = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
                dnew = np.where(m, dc, 0) + live * leave * (1 - tanh**2)
                gates = np.concatenate(
                    [dnew * c * forget * (1 - forget), dnew * g * enter * (1 - enter), live * tanh * leave * (1 - leave), dnew * enter * (1 - g**2)], axis=1
                )
                dgiven[t] = gates
                grad_h += h.T @ gates
                dh = np.where(m, gates @ w[f"h{side}"].T, dh)
                dc = np.where(m, dnew * forget, dc)
            out[f"x{side}"] = np.einsum("tpi,tpj->ij", x, dgiven)
            out[f"h{side}"], out[f"c{side}"] = grad_h, dgiven.sum((0, 1))
        return loss, out

    def label(self, pages: list[np.ndarray], step_cells: int = 40_000) -> list[np.ndarray]:
        """Per page which blocks are main text; pages of like length share a batch of bounded size."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        at = 0
        while at < len(order):
            upto = at + 1
            while upto < len(order) and (upto + 1 - at) * len(pages[order[upto]]) <= step_cells and upto - at < 512:
                upto += 1
            some = order[at:upto]
            x, mask = padded([pages[i] for i in some])
            if len(x):
                z = self.logits(x, mask)
                for k, i in enumerate(some):
                    out[i] = z[: len(pages[i]), k] > 0
            at = upto
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), INPUT)), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, True
    return x, mask


def varied(blocks: list[Block], labels: np.ndarray, others: list[Block], rng) -> tuple[list[Block], np.ndarray]:
    """A variant of a page: containers renamed, markup stripped, or blocks of other pages put in as surroundings."""
    contents = [(("article", ()),), (("main", ()),), (("div", ("content",)),), (("div", ("post", "body")),), (("div", ()), ("div", ()))]
    outside = sorted(SURROUNDINGS - {"hidden"})
    strip = rng.random() < 0.25
    inner = contents[4] if strip else contents[rng.integers(len(contents) - 1)]
    rename = rng.random() < 0.6
    out, kept = [], []

    def surrounded() -> tuple:
        word = outside[rng.integers(len(outside))]
        return (word, ()) if word in BLOCKS else (("div", "section", "ul")[rng.integers(3)], (word,) if rng.random() < 0.5 else (word, "box"))

    def put_in(around: tuple) -> None:
        wrap = surrounded()
        for _ in range(rng.integers(1, 4)):
            b = others[rng.integers(len(others))]
            leaf = (("p", ()), ("li", ()), ("div", ()))[rng.integers(3)]
            linked = len(b.text) if rng.random() < 0.4 else 0
            out.append(Block((*around, wrap, leaf), b.text[: int(rng.integers(10, 300))].strip() or "x", linked))
            kept.append(0.0)

    body = (("html", ()), ("body", ()))
    swap: dict[tuple, tuple] = {}
    for b, y in zip(blocks, labels, strict=True):
        leaf = b.path[-1:] if b.path and b.path[-1][0] in LEAVES else (("p", ()),)
        path = b.path
        if y and (rename or strip):
            path = (*body, *inner, *leaf)
        elif not y and (rename or strip):
            top = b.path[:-1]
            swap.setdefault(top, (("div", ()),) if strip else (surrounded(),))
            path = (*body, *swap[top], *leaf)
        if rng.random() < 0.06:
            put_in((*body, *(inner if y else ())))
        out.append(Block(path, b.text, b.linked))
        kept.append(float(y))
    if rng.random() < 0.5:
        put_in(body)
    return out, np.array(kept)


def train_labeller(pages: list[str], hidden: int = 16, rounds: int = 12, variants: int = 3, seed: int = 7, rate: float = 0.01) -> Labeller | None:
    """Fit on pages given as HTML by Adam; None if no block of them is main text."""
    rng = np.random.default_rng(seed)
    parsed = [b for b in map(blocks_of, pages) if b]
    labelled = [(b, weak_labels(b)) for b in parsed]
    if not any(y.any() for _, y in labelled):
        return None
    others = [b for p in parsed for b in p][:20_000]
    known: dict[str, int] = {}
    examples = [(vectors(b, known), y) for b, y in labelled]
    for _ in range(variants):
        examples += [(vectors(b, known), y) for b, y in (varied(b, y, others, rng) for b, y in labelled)]
    examples = [(x[:400], y[:400]) for x, y in examples]
    net = Labeller.fresh(hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2))
    step = 0
    for _ in range(rounds):
        order = sorted(rng.permutation(len(examples)), key=lambda i: len(examples[i][0]) // 8)
        batches = [order[i : i + 48] for i in range(0, len(order), 48)]
        for k in rng.permutation(len(batches)):
            some = [examples[i] for i in batches[k]]
            x, mask = padded([e[0] for e in some])
            y = np.zeros(mask.shape)
            for i, e in enumerate(some):
                y[: len(e[1]), i] = e[1]
            _, grads = net.gradients(x, mask, y)
            norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
            step += 1
            for name, g in grads.items():
                g = g * min(1.0, 1.0 / (norm + 1e-12))
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                net.weights[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return net


def main_text(pages: list[str | None], labeller: Labeller | None, known: dict[str, int]) -> list[str]:
    """The main text of whole pages: the blocks labelled so, in order, one line each."""
    parsed = [blocks_of(p) for p in pages]
    if labeller is None:
        chosen = [weak_labels(b) > 0 for b in parsed]
    else:
        chosen = labeller.label([vectors(b, known) for b in parsed])
    return ["\n".join(b.text for b, y in zip(blocks, mark, strict=True) if y) for blocks, mark in zip(parsed, chosen, strict=True)]


_TEXT, _TEXT_DDL = arrow_schema(page_id="long", url="string", text="string", n_chars="long")


def _extract(batches, labeller: Labeller | None, most: int = 256):
    known: dict[str, int] = {}
    for batch in batches:
        for at in range(0, len(batch), most):
            some = batch.slice(at, most)
            texts = main_text(some.column(2).to_pylist(), labeller, known)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=_TEXT
            )


def extract_main_text(
    pages: DataFrame, sample_pages: int = 300, sample_chars: int = 100_000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars.

    The labeller is fitted on at most ``sample_pages`` pages picked by a hash of their id, of each the first
    ``sample_chars`` characters; every page is then read whole. NULL pages are empty, NULL ids and addresses stay NULL,
    repeated rows appear again, other columns are ignored, and an empty table gives no rows. If no sampled block is
    main text by its markup, the markup alone decides.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")
    )
    many = max(1, rows.count())
    share = min(1.0, 1.5 * sample_pages / many)
    near = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    picked = rows.filter(near).select("page_id", F.substring("html", 1, sample_chars).alias("html")).limit(sample_pages).collect()
    picked = sorted((r["html"] or "" for r in picked), key=lambda t: (zlib.crc32(t.encode()), t))
    labeller = train_labeller(picked)
    return rows.mapInArrow(partial(_extract, labeller=labeller), _TEXT_DDL)
