"""Benchmark decontamination by template canonicalisation, in built-in functions only.

Numbers, names and units become typed placeholders, so a question with other numbers or names keeps its template.
Both sides are cut into windows of template tokens. Of each benchmark item only the windows that start with its rarest
words are joined, by hash: a document with at least ``share`` of an item's windows must hold one of any ``1 - share``
of them (and one more), so documents hash only where such a word stands, and nothing is lost. Candidates are then verified on the whole document: the share of
the item's windows, and whether the slots that line up with the item's are filled consistently (equal values by equal
ones) at any place where enough of its windows stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import few_ids, fresh, text_column

#: Measures and currencies that count as units wherever they stand, and signs that do only beside a number.
UNIT_WORDS = tuple(
    "km cm mm mile miles feet foot inch inches yard yards kg mg lb lbs pound pounds ounce ounces ton tons ml liter liters litre "
    "litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years mph percent "
    "degree degrees dollar dollars euro euros cent cents usd eur gbp kb mb gb tb hz khz mhz ghz kw kcal".split()
)
UNIT_SIGNS = "km/h|m/s|mi|ft|oz|sec|min|hrs?|°[cf]?|[$€£%]|kj|cal|pa|[mglshwvjn]"
_NUMBER = r"(?<![\p{L}\p{Nd}])\p{Nd}+(?:[.,]\p{Nd}+)*"
#: Words that open sentences and are no names: articles, pronouns, question words, prepositions, conjunctions, auxiliaries
#: and the verbs of exercises, in English, German, French and Spanish. Fixed values.
STARTERS = tuple(
    "A An The This That These Those There Here It He She We You They I My Your His Her Its Our Their One Some Any All Each Every Both "
    "What Which Who Whom Whose When Where Why How If In On At By For From To Of With Without After Before While Since As And Or But So "
    "Then Thus Let Is Are Was Were Do Does Did Can Could Will Would Should Must Has Have Had Not No Yes Find Given Suppose Assume "
    "Der Die Das Ein Eine Wie Was Wer Wo Wann Warum Im Es Er Sie Wir Ich Und Oder Aber Wenn Von Mit Zu Auf "
    "Le La Les Un Une Il Elle Ils Nous Vous Je Est Et Ou Mais Si Dans De Du Des Qui Que Quel Quelle Comment Pourquoi Quand "
    "El Los Las Una Uno En Del Y O Es Son Por Para Con Se Su Al Como Cuando Donde Si Que Lo".split()
)
_NAME = rf"(?<![\p{{L}}\p{{Nd}}])(?=\p{{Lu}})(?!(?:{'|'.join(sorted(set(STARTERS), key=lambda w: (-len(w), w)))})(?!\p{{L}}))\p{{Lu}}\p{{Ll}}+"
#: ASCII other than digits, letters and ``<=>_``, and the general and CJK punctuation beyond it.
_BETWEEN = r"[\x00-\x2F\x3A\x3B\x3F\x40\x5B-\x5E\x60\x7B-\x7F\u00A0-\u00A9\u00AB-\u00B4\u00B6-\u00B9\u00BB-\u00BF\u2000-\u206F\u3000-\u303F]+"
#: Items of fewer words match whole documents only.
SHORTEST = 3
#: Broadcast the item windows, or the candidate documents, up to this many rows (some 50 bytes each), else shuffle.
BROADCAST_ROWS = 500_000
#: First words of the joined windows up to this number are a filter in the scan; beyond it every window is joined.
LISTED_WORDS = 5_000


def template_tokens(text: Column, values: bool = False) -> Column:
    """The words of a text in lower case, with ``<num>``, ``<name>`` and ``<unit>`` for what varies.

    A name is a capitalised word wherever it stands, other than the ``STARTERS`` of sentences. With ``values`` a
    placeholder holds what it stands for, as in ``<num=12>``.
    """
    put = lambda kind, group: f"<{kind}=${group}>" if values else f"<{kind}>"
    odd = text.contains("<") | text.contains(">") | text.contains("=") | text.contains("_")
    text = F.when(odd, F.regexp_replace(text, r"[<>=_]+", " ")).otherwise(text)
    text = F.regexp_replace(text, rf"({_NAME})", put("name", 1))
    counted = F.regexp_replace(text, r"([$€£])\s?(?=\p{Nd})", f" {put('unit', 1)} ")
    counted = F.regexp_replace(counted, rf"({_NUMBER})\s?(?i:({UNIT_SIGNS}))(?![\p{{L}}\p{{Nd}}])", f" {put('num', 1)} {put('unit', 2)} ")
    # A number in a placeholder already written follows "=", which the pattern below does not accept.
    counted = F.regexp_replace(counted, rf"(?<!=)({_NUMBER})(?![^<]*>)" if values else rf"({_NUMBER})", f" {put('num', 1)} ")
    if values:
        # "=" stands in placeholders only. Signs in their values become words, as they would part the placeholder.
        for sign, name in (("[$]", "usd"), ("€", "eur"), ("£", "gbp"), ("%", "percent"), ("°", "degrees"), *[("[/.,]", "_")] * 6):
            counted = F.regexp_replace(counted, rf"(=[^<> ]*?){sign}([^<> ]*>)", f"$1{name}$2")
    text = F.when(text.rlike(r"\p{Nd}"), counted).otherwise(text)
    words = F.array_remove(F.split(F.lower(text), _BETWEEN), "")
    return F.transform(words, lambda w: F.when(w.isin(*UNIT_WORDS), F.concat(F.lit("<unit="), w, F.lit(">")) if values else F.lit("<unit>")).otherwise(w))


def _window(tokens: Column, i: Column, size: int) -> Column:
    """The hash of the window at ``i`` if it has two literal words; a text shorter than a window is one with its literal."""
    parts = [F.get(tokens, i + k) for k in range(size)]
    literal = sum((F.when(p.startswith("<"), 0).otherwise(1) for p in parts), F.lit(0))
    short = F.exists(tokens, lambda t: ~t.startswith("<"))
    return F.when(i + size <= F.size(tokens), F.when(literal >= 2, F.xxhash64(*parts))).when((F.size(tokens) < size) & (i == 0) & short, F.xxhash64(tokens))


def _windows(tokens: Column, size: int) -> Column:
    """The windows' hashes by place, NULL where there is none."""
    return F.transform(tokens, lambda t, i: _window(tokens, i, size))


def _items(benchmark: DataFrame, size: int, share: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Per item what verification needs, and the (window, first, item) rows to join: those with its rarest first words."""
    rows = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), text_column(text_col).alias("item_text"))
    rows = rows.select("item_id", F.xxhash64("item_text").alias("item"), template_tokens(F.col("item_text"), True).alias("item_values"))
    tokens = F.transform("item_values", lambda v: F.when(v.startswith("<"), F.concat(F.substring_index(v, "=", 1), F.lit(">"))).otherwise(v))
    rows = rows.withColumn("item_tokens", tokens)
    rows = rows.withColumn("item_all", _windows(F.col("item_tokens"), size))
    rows = rows.withColumn("item_windows", F.array_distinct(F.array_compact("item_all"))).filter(F.size("item_windows") > 0)
    rows = store(rows.dropDuplicates(["item_id", "item"]), "benchmark-items")
    firsts = F.transform("item_windows", lambda w: F.struct(w.alias("window"), F.element_at("item_tokens", F.array_position("item_all", w).cast("int")).alias("first")))
    each = rows.select("item_id", "item", F.explode(firsts).alias("w")).select("item_id", "item", "w.*")
    return rows, store(_rarest(each.withColumn("w", F.lit(size)), share).drop("w"), "benchmark-windows")


def plain_tokens(text: Column) -> Column:
    """The words and numbers of a text in lower case, as they are."""
    return F.array_remove(F.split(F.lower(text), _BETWEEN), "")


def _rarest(each: DataFrame, share: float) -> DataFrame:
    """Of (item_id, item, window, first, w): the windows of which a document with ``share`` of them must hold one,
    those whose first words the fewest items' windows begin with."""
    often = each.groupBy("first").agg(F.count(F.lit(1)).alias("often"))
    order = F.struct("often", (-F.length("first")).alias("short"), "window", "first", "w")
    ranked = each.join(often, "first").groupBy("item_id", "item").agg(F.array_sort(F.collect_list(order)).alias("all"))
    needed = F.floor(F.size("all") * F.lit(round(1 - share, 9)) + F.lit(1e-9)).cast("int") + 1
    joined = ranked.select("item_id", "item", F.explode(F.slice("all", F.lit(1), needed)).alias("x"))
    return joined.select("item_id", "item", "x.window", "x.first", "x.w")


def _at_firsts(w: int, listed: list[str]) -> Column:
    """The windows of ``w`` tokens that begin with a listed word, or all if the list is too long."""
    tokens = F.col("tokens")
    hashed = lambda i: F.when(i + w <= F.size(tokens), F.xxhash64(F.slice(tokens, i + 1, w)))
    if len(listed) > LISTED_WORDS:
        return F.transform(tokens, lambda t, i: hashed(i))
    return F.transform(tokens, lambda t, i: F.when(t.isin(listed), hashed(i)))


def _plain_pairs(docs: DataFrame, benchmark: DataFrame, size: int, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """Pairs with all of an item's windows of words as they are: items in another case, with too few literal words for a
    template, or shorter than a window, which then is as long as the item."""
    slices = lambda tokens, w: F.when(F.size(tokens) >= w, F.transform(
        F.sequence(F.lit(0), F.size(tokens) - w), lambda i: F.xxhash64(F.slice(tokens, i + 1, w)))).otherwise(F.array().cast("array<bigint>"))
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), text_column(item_text_col).alias("item_text"))
    items = items.select("item_id", F.xxhash64("item_text").alias("item"), plain_tokens(F.col("item_text")).alias("item_tokens"))
    items = items.filter(F.size("item_tokens") >= SHORTEST).withColumn("w", F.least(F.size("item_tokens"), F.lit(size)))
    items = items.withColumn("item_all", slices(F.col("item_tokens"), F.col("w"))).withColumn("item_windows", F.array_distinct("item_all"))
    items = store(items.dropDuplicates(["item_id", "item"]), "benchmark-plain")
    firsts = F.transform("item_windows", lambda h: F.struct(h.alias("window"), F.element_at("item_tokens", F.array_position("item_all", h).cast("int")).alias("first"), F.col("w")))
    wanted = store(_rarest(items.select("item_id", "item", F.explode(firsts).alias("x")).select("item_id", "item", "x.*"), 1.0), "benchmark-plain-windows")
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), plain_tokens(text_column(text_col)).alias("tokens"))
    sizes = sorted(r["w"] for r in wanted.select("w").distinct().collect())  # from SHORTEST to size
    at = [_at_firsts(w, [r["first"] for r in wanted.filter(F.col("w") == w).select("first").distinct().limit(LISTED_WORDS + 1).collect()]) for w in sizes]
    at = F.array_distinct(F.array_compact(F.concat(*at))) if at else F.array().cast("array<bigint>")
    few = wanted.count() <= BROADCAST_ROWS
    windows = source.select("doc_id", F.explode(at).alias("window"))
    pairs = store(windows.join(F.broadcast(wanted) if few else wanted, "window").select("doc_id", "item_id", "item", "w").distinct(), "plain-candidates")
    # An item that is one window is found whole already.
    short = pairs.filter(F.col("w") < size).select("doc_id", "item_id", F.lit(1).alias("n"), F.lit(1).alias("matched"))
    known = store(pairs.filter(F.col("w") == size).groupBy("doc_id").agg(F.collect_set(F.struct("item_id", "item")).alias("items")), "plain-documents")
    some = known if known.count() > BROADCAST_ROWS else F.broadcast(known)
    texts = source.alias("d").join(some.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")))
    texts = texts.select("d.doc_id", slices(F.col("tokens"), F.lit(size)).alias("windows"), F.explode("items").alias("i"))
    both = texts.select("doc_id", "windows", F.col("i.item_id").alias("item_id"), F.col("i.item").alias("item")).alias("t").join(
        items.alias("b"), (F.col("t.item") == F.col("b.item")) & F.col("t.item_id").eqNullSafe(F.col("b.item_id"))
    )
    whole = both.select("doc_id", "t.item_id", F.size("item_windows").alias("n"), F.size(F.array_intersect("windows", "item_windows")).alias("matched"))
    return whole.unionByName(short).filter("matched = n").select(
        "doc_id", "item_id", F.col("n").cast("long").alias("windows"), F.col("matched").cast("long").alias("matched"), F.lit(1.0).alias("share"),
        F.lit(0).cast("long").alias("slots"), F.lit(False).alias("reparameterised"),
    )


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The documents that hold a benchmark item: doc_id, item_id, windows, matched, share, slots, reparameterised.

    One row per pair. A document holds an item if it has at least ``share`` of the item's distinct template windows,
    with slots filled consistently at some place; ``reparameterised`` says that at none of them all slots hold the
    item's values. It also holds an item of which it has all windows of plain words, whatever their case: so whole
    copies of items without literal words are found, and of ones shorter than a window, down to three words, by one
    window as long as they are. Template windows need two literal words; a template shorter than a window is one window and
    matches a document of the same words. NULL and empty texts match nothing; a NULL id gives pairs with NULL;
    repeated rows count once, with their best share; other columns are ignored.
    """
    template = _template_pairs(docs, benchmark, size, share, id_col, text_col, item_col, item_text_col)
    plain = _plain_pairs(docs, benchmark, size, id_col, text_col, item_col, item_text_col)
    best = F.max(F.struct("share", "windows", "matched", "slots", (~F.col("reparameterised")).alias("same")))
    best = template.unionByName(plain).groupBy("doc_id", "item_id").agg(best.alias("best"))
    return best.select("doc_id", "item_id", "best.windows", "best.matched", "best.share", "best.slots", (~F.col("best.same")).alias("reparameterised"))


def _template_pairs(docs: DataFrame, benchmark: DataFrame, size: int, share: float, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame:
    """Pairs by template windows, one row per place of a document that is verified."""
    items, wanted = _items(benchmark, size, share, item_col, item_text_col)
    listed = [r["first"] for r in wanted.select("first").distinct().limit(LISTED_WORDS + 1).collect()]
    few = wanted.count() <= BROADCAST_ROWS
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_column(text_col).alias("doc_text"))
    tokens = source.select("doc_id", template_tokens(F.col("doc_text")).alias("tokens"))
    if len(listed) <= LISTED_WORDS:
        at = F.transform("tokens", lambda t, i: F.when(t.isin(listed), _window(F.col("tokens"), i, size)))
    else:
        at = _windows(F.col("tokens"), size)
    windows = tokens.select("doc_id", F.explode(F.array_compact(at)).alias("window"))
    pairs = windows.join(F.broadcast(wanted) if few else wanted, "window").select("doc_id", "item_id", "item").distinct()
    pairs = store(pairs, "contamination-candidates")

    known = store(pairs.groupBy("doc_id").agg(F.collect_set(F.struct("item_id", "item")).alias("items")), "candidate-documents")
    some = known if known.count() > BROADCAST_ROWS else F.broadcast(known)
    texts = source.alias("d").join(some.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")))
    texts = texts.select("d.doc_id", "doc_text", "items", template_tokens(F.col("doc_text")).alias("tokens")).select(
        "doc_id", "doc_text", _windows(F.col("tokens"), size).alias("windows"), F.explode("items").alias("i")
    )
    both = texts.select("doc_id", "doc_text", "windows", F.col("i.item_id").alias("item_id"), F.col("i.item").alias("item")).alias("t").join(
        items.alias("b"), (F.col("t.item") == F.col("b.item")) & F.col("t.item_id").eqNullSafe(F.col("b.item_id"))
    )
    matched = F.size(F.array_intersect("windows", "item_windows"))
    found = both.select(
        "doc_id", "t.item_id", "doc_text", "windows", "item_all", "item_values", F.size("item_windows").alias("n"), matched.alias("matched"),
    ).withColumn("share", F.col("matched") / F.col("n")).filter(F.col("share") >= share - 1e-9)
    # Only items with slots need to be lined up: wherever ``share`` of the windows stand about one distance from the
    # item's, and at the commonest distance. A word put in moves the windows behind it, so a slot goes with its window.
    slotted = F.exists("item_values", lambda v: v.startswith("<"))
    spot = lambda w, i: F.transform("windows", lambda d, p: F.when(d == w, F.struct(i.alias("i"), (p - i).alias("d"))))
    found = found.withColumn("spots", F.when(slotted, F.flatten(F.transform("item_all", lambda w, i: F.array_compact(spot(w, i))))))
    found = found.withColumn("values", F.when(slotted, template_tokens(F.col("doc_text"), True))).drop("doc_text", "windows")
    found = store(found, "contamination-spots")  # else the filter below would compute both anew for every element
    about = lambda s: F.filter("spots", lambda q: F.abs(q["d"] - s) <= size)
    starts = F.transform(F.array_distinct(F.col("spots.d")), lambda s: F.struct(
        F.size(F.filter("spots", lambda q: q["d"] == s)).alias("n"), (-s).alias("p"),
        F.size(F.array_distinct(F.transform(about(s), lambda q: q["i"]))).alias("about"),
    ))
    found = found.withColumn("starts", starts).withColumn("common", F.array_max("starts")).withColumn(
        "chosen", F.filter("starts", lambda c: (c["about"] >= F.size(F.array_compact("item_all")) * share - 1e-9) | (c["p"] == F.col("common.p")))
    )
    off = lambda q, j: F.greatest(q["i"] - j, j - q["i"] - (size - 1), F.lit(0))
    shift = lambda s, j: F.array_min(F.transform(about(s), lambda q: F.struct(off(q, j).alias("off"), F.abs(q["d"] - s).alias("gap"), q["d"].alias("d"))))["d"]
    kind = lambda v: F.substring_index(v, "=", 1)
    lined = lambda s: F.transform("item_values", lambda v, j: F.when(v.startswith("<"), F.struct(v.alias("a"), F.get("values", (shift(s, j) + j).cast("int")).alias("b"))))
    slots = lambda s: F.array_distinct(F.filter(F.array_compact(lined(s)), lambda p: kind(p["a"]) == kind(F.coalesce(p["b"], F.lit("")))))
    found = found.withColumn("lined", F.when(F.col("values").isNotNull(), F.transform("chosen", lambda c: slots(-c["p"]))).otherwise(F.array(F.array().cast("array<struct<a:string,b:string>>"))))
    consistent = F.filter("lined", lambda x: F.size(F.array_distinct(F.transform(x, lambda p: p["a"]))) == F.size(x))
    fits = F.transform(consistent, lambda x: F.struct((F.size(x) > 0).alias("some"), (~F.exists(x, lambda p: p["a"] != p["b"])).alias("same"), F.size(x).alias("slots")))
    return found.withColumn("fit", F.array_max(fits)).filter(F.col("fit").isNotNull()).select(
        "doc_id", "item_id", F.col("n").cast("long").alias("windows"), F.col("matched").cast("long").alias("matched"), "share",
        F.col("fit.slots").cast("long").alias("slots"), (~F.col("fit.same")).alias("reparameterised"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows without a contaminated pair, all columns unchanged."""
    name = fresh("contaminated_id", docs.columns)
    gone = contaminated_pairs(docs, benchmark, size, share, id_col, text_col).select(F.col("doc_id").alias(name)).distinct()
    gone = few_ids(store(gone, "contaminated"))
    return docs.join(gone, docs[f"`{id_col}`"].eqNullSafe(F.col(name)), "left_anti")
