"""Licence scans by a positional index of rare words, in built-in functions only.

Templates are short word sequences with a key phrase that must stand. One pass over the texts keeps of each file
the places of the licence words (``place * 256 + word``) and counts in how many files each word is. A template is
looked up by the word of its key phrase with the highest inverse document frequency; every place of that word gives
a start, the key phrase is verified there word by word, and the postings of the template's other words are looked up
by relative position where it stands, also between foreign words. So a file costs its rare words, and no place of a key phrase is missed: each holds its
rarest word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import ascii_lower, text_column


@dataclass(frozen=True)
class Template:
    """``words`` as they stand in a notice; the ``key`` phrase among them is mandatory."""

    label: str
    words: str
    key: str
    base: bool = False


#: The base phrases and labels come first and stand for themselves; the rest are notices in common use.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("reserved", "all rights reserved", "all rights reserved", base=True),
    Template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)

#: What stands between words: ASCII other than digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = 0.6


def _vocabulary(templates) -> list[str]:
    return sorted({w for t in templates for w in t.words.split()})


def licence_places(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, seen (licence words of the file), all_hits (place * 256 + word) and hits (those a key phrase can hold).

    A word of a key phrase stands beside another licence word, unless a key phrase is a single word.
    """
    vocabulary = _vocabulary(templates)
    if len(vocabulary) > 256:
        raise ValueError("more than 256 licence words")
    words = F.array_remove(F.split(ascii_lower(text_column(text_col)), BETWEEN), "")
    number = F.create_map([x for i, w in enumerate(vocabulary) for x in (F.lit(w), F.lit(i).cast("long"))])
    read = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words.alias("words")).select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.array_compact(
            F.transform("words", lambda w, i: F.when(w.isin(vocabulary), i.cast("long") * 256 + number[w]))
        ).alias("all_hits"),
    )
    beside = lambda c, d: F.coalesce(F.shiftright(c, 8) + 1 == F.shiftright(d, 8), F.lit(False))
    hits = F.filter("all_hits", lambda c, i: beside(c, F.get("all_hits", i + 1)) | beside(F.get("all_hits", i - 1), c))
    if any(len(t.key.split()) == 1 for t in templates):
        hits = F.col("all_hits")
    seen = F.array_distinct(F.transform("all_hits", lambda c: c.bitwiseAND(255)))
    return read.select("doc_id", "n_words", seen.alias("seen"), "all_hits", hits.alias("hits"))


def _weights(places: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """The inverse document frequency of every licence word over all files."""
    files = places.count()
    found = places.select(F.explode("seen").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["word"]: r["n"] for r in found}  # at most one row per licence word
    return {w: math.log((files + 1) / (counts.get(i, 0) + 0.5)) for i, w in enumerate(vocabulary)}


def _find(template: Template, weights: dict[str, float], number: dict[str, int]):
    """An array of (start, weight of the words that stand there) of one template, key phrase verified."""
    words, key = template.words.split(), template.key.split()
    at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    anchor = max(range(at, at + len(key)), key=lambda i: (weights[words[i]], -i))
    rare = F.filter("hits", lambda c: c.bitwiseAND(255) == number[words[anchor]])
    starts = F.transform(rare, lambda c: F.shiftright(c, 8) - anchor)
    stands = lambda s, i, hits="hits": F.array_contains(hits, (s + i) * 256 + number[words[i]])

    def verified(s):
        found = F.lit(True)
        for i in range(at, at + len(key)):
            if i != anchor:
                found = found & stands(s, i)
        return found

    def weight(s):
        found = F.lit(0.0)
        for i, w in enumerate(words):
            known = at <= i < at + len(key)
            found = found + (F.lit(weights[w]) if known else F.when(stands(s, i, "all_hits"), F.lit(weights[w])).otherwise(F.lit(0.0)))
        total = sum(weights[w] for w in words)
        return F.least(F.lit(1.0), found / total if total else F.lit(1.0))

    return F.transform(F.filter(starts, verified), lambda s: F.struct((s + at).alias("start"), weight(s).alias("share")))


def scan_licences(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, letters (A-Z in lower case) and anything beyond ASCII. ``n_base`` counts every place of
    a base phrase, and first_word and last_word are the smallest and largest start (NULL if none). A label of
    another template is given where its key phrase stands and the words that stand around it carry at least ``share``
    of the template's weight; ``score`` is the largest share found, 1 for a base phrase and 0 for none. NULL texts
    count as empty; repeated rows appear again; other columns are ignored; an empty table gives no rows.
    """
    vocabulary = _vocabulary(templates)
    places = store(licence_places(docs, templates, id_col, text_col), "licence-places")
    weights, number = _weights(places, vocabulary), {w: i for i, w in enumerate(vocabulary)}
    names = [f"t{i}" for i in range(len(templates))]
    found = places.select(
        "doc_id", "n_words", *[_find(t, weights, number).alias(n) for t, n in zip(templates, names, strict=True)]
    )
    base = [n for n, t in zip(names, templates, strict=True) if t.base]
    starts = F.flatten(F.array(*[F.col(f"{n}.start") for n in base]))
    best = F.array(*[F.coalesce(F.array_max(F.col(f"{n}.share")), F.lit(0.0)) for n in names])
    given = lambda chosen: F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(F.array(*chosen)))))
    base_labels = [F.when(F.size(n) > 0, F.lit(t.label)) for n, t in zip(names, templates, strict=True) if t.base]
    labels = [F.when(F.size(F.filter(n, lambda x: x["share"] >= share)) > 0, F.lit(t.label)) for n, t in zip(names, templates, strict=True)]
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), given(base_labels).alias("base_labels"), given(labels).alias("labels"),
        F.round(F.array_max(best), 6).alias("score"),
    )


def licence_sql(templates=TEMPLATES, share: float = SHARE) -> str:
    """The same scan over ``documents`` as DuckDB SQL: key phrases by joins on relative positions."""
    rows = []
    for t, template in enumerate(templates):
        words, key = template.words.split(), template.key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        rows += [f"({t}, '{template.label}', {template.base}, {at}, {i}, '{w}', {int(at <= i < at + len(key))})" for i, w in enumerate(words)]
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BETWEEN}'), lambda x: x <> '') AS ws FROM documents
), w AS (
  SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d
), tw(t, label, base, ahead, i, word, is_key) AS (VALUES {', '.join(rows)}
), weights AS (
  SELECT word, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT rid) + 0.5::double)) AS weight
  FROM (SELECT DISTINCT word FROM tw) LEFT JOIN w USING (word) GROUP BY word
), totals AS (
  SELECT t, sum(weight) AS total, sum(is_key) AS n_key FROM tw JOIN weights USING (word) GROUP BY t
), hits AS (
  SELECT rid, t, pos - i AS s, sum(is_key) AS n_key, sum(weight) AS weight FROM w JOIN tw USING (word) JOIN weights USING (word) GROUP BY ALL
), places AS (
  SELECT DISTINCT rid, hits.t, label, base, s + ahead AS start, least(1.0, weight / total) AS share
  FROM hits JOIN totals ON hits.t = totals.t AND hits.n_key = totals.n_key JOIN (SELECT DISTINCT t, label, base, ahead FROM tw) x ON x.t = hits.t
), found AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (share >= {share}) AS labels, max(share) AS score
  FROM places GROUP BY rid
)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(n_base, 0)::bigint AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6)::double AS score
FROM d LEFT JOIN found USING (rid)
"""
