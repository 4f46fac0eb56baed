"""Decontamination, licences and toxicity against brute force and held-out labels."""

import re
import zlib

import duckdb
import pytest

from ringspan.llm import decontaminate, licences, queries, toxicity

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ITEM = "A train leaves Boston at 12 and travels 45 km every hour, so how many km has it gone when Mary meets it after 12 hours"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "c", 1, None) for d, t in rows], "doc_id long, text string, item_id string, share int, windows string")


def items(spark, rows):
    return spark.createDataFrame([(d, t, "c") for d, t in rows], "item_id long, text string, doc_id string")


def test_template_tokens(spark):
    text = "we met Anna Smith, Bob and the Cat. The Dog ran 12.5 km for $3 or 7 euros in 1,000 days at B2 <num>"
    row = spark.createDataFrame([(text,)], "t string").select(
        decontaminate.template_tokens(decontaminate.F.col("t")).alias("a"), decontaminate.template_tokens(decontaminate.F.col("t"), True).alias("b")
    ).first()
    assert " ".join(row["a"]) == (
        "we met <name> <name> <name> and the <name> the <name> ran <num> <unit> for <unit> <num> or <num> <unit> in <num> <unit> at b2 num"
    )
    assert len(row["a"]) == len(row["b"])
    values = [v for v in row["b"] if v.startswith("<")]
    assert values == ["<name=anna>", "<name=smith>", "<name=bob>", "<name=cat>", "<name=dog>", "<num=12_5>", "<unit=km>", "<unit=usd>", "<num=3>", "<num=7>", "<unit=euros>", "<num=1_000>", "<unit=days>"]


def test_contaminated_odd_rows(spark):
    other = ITEM.replace("12", "31").replace("45 km", "60 miles").replace("km", "miles").replace("Mary", "Zoe").replace("Boston", "Paris")
    crossed = ITEM.replace("at 12", "at 31")
    filler = "some words of no import stand here and there in every single file we read "
    rows = [
        (1, filler + ITEM + " " + filler), (2, filler + other), (3, filler + crossed), (4, filler * 50), (5, None), (6, ""), (7, ITEM[: len(ITEM) // 2]),
        (8, ITEM), (8, ITEM), (9, "yes no"), (10, "yes it is"), (13, "Yes, NO!"), (None, filler + ITEM), (11, filler * 3000 + ITEM + filler * 3000), (12, "12 12 12 12 12 12 12"),
    ]
    bench = [(1, ITEM), (2, "yes no"), (3, None), (4, ""), (5, "12 13 14 15 16 17"), (1, ITEM), (None, "a question that has no number of its own in the table")]
    found = decontaminate.contaminated_pairs(docs(spark, rows).repartition(5), items(spark, bench)).collect()
    got = {(r["doc_id"], r["item_id"], r["reparameterised"]) for r in found}
    assert got == {(1, 1, False), (2, 1, True), (8, 1, False), (9, 2, False), (13, 2, False), (None, 1, False), (11, 1, False)}
    kept = decontaminate.drop_contaminated(docs(spark, rows), items(spark, bench))
    assert kept.columns == ["doc_id", "text", "item_id", "share", "windows"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 7, 10, 12]
    assert decontaminate.contaminated_pairs(docs(spark, []), items(spark, bench)).collect() == []
    assert decontaminate.contaminated_pairs(docs(spark, rows), items(spark, [])).collect() == []


def test_questions_a_template_alone_would_lose(spark):
    """Names that open sentences, items without literal words, items shorter than a window, copies in another case."""
    bench = [
        (1, "Tom has 3 apples. Tom buys 4 more apples. How many apples does Tom have now in all his bags?"), (2, "12 + 13 + 14 + 15 = ?"),
        (3, "Who wrote Hamlet?"), (4, ITEM), (5, "7 x 8"), (6, "No way"),
    ]
    other = "Anna has 5 apples. Anna buys 6 more apples. How many apples does Anna have now in all her bags?"
    mixed = "Anna has 5 apples. Bella buys 6 more apples. How many apples does Carl have now in all his bags?"
    filler = " some words of no import stand here and there "
    rows = [
        (1, filler + other), (2, filler + mixed), (3, f"{filler}12 + 13 + 14 + 15 = ?{filler}"), (4, f"{filler}12 + 13 + 41 + 15 = ?"),
        (5, f"{filler}who wrote Hamlet, they ask{filler}"), (6, f"{filler}who wrote Faust, they ask{filler}"), (7, filler + ITEM.lower()),
        (8, filler + ITEM.upper()), (9, "7 X 8"), (10, f"there is no way {filler}"), (11, "NO WAY"), (12, filler), (13, filler + bench[0][1].lower()),
    ]
    found = decontaminate.contaminated_pairs(docs(spark, rows).repartition(4), items(spark, bench)).collect()
    got = {(r["doc_id"], r["item_id"], r["reparameterised"]) for r in found}
    assert got == {(1, 1, True), (3, 2, False), (5, 3, False), (7, 4, False), (8, 4, False), (9, 5, False), (11, 6, False), (13, 1, False)}


def test_any_place_of_an_item_is_lined_up(spark):
    crossed = ITEM.replace("at 12", "at 31")
    equal = ITEM.replace("12", "45")
    inserted = ITEM.replace("so how many", "so just how many")
    filler = " some words of no import stand here and there "
    rows = [
        (1, crossed + filler + ITEM), (2, ITEM + filler + crossed), (3, crossed + filler + crossed), (4, filler + equal), (5, filler + inserted),
        (6, (crossed + filler) * 20 + ITEM + filler), (7, filler + inserted.replace("12", "31")),
    ]
    found = decontaminate.contaminated_pairs(docs(spark, rows), items(spark, [(1, ITEM)])).collect()
    assert {(r["doc_id"], r["reparameterised"]) for r in found} == {(1, False), (2, False), (4, True), (5, False), (6, False), (7, True)}


def template(text):
    """The placeholder-free template words by other means: digits and names do not occur in the tables' items."""
    return [w for w in re.split(r"[^\w]+", (text or "").lower()) if w]


@pytest.mark.parametrize("sf", [LARGER])
def test_contaminated_query_finds_every_full_passage(spark, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op8_decontamination"](spark, sf).collect()}
    exact = {(d["doc_id"], b["item_id"]) for b in bench for d in rows if b["text"] in (d["text"] or "")}
    assert exact and exact <= found
    for doc_id, item_id in found:
        words = template(next(d["text"] for d in rows if d["doc_id"] == doc_id))
        item = template(next(b["text"] for b in bench if b["item_id"] == item_id))
        have = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        want = {tuple(item[i : i + 5]) for i in range(len(item) - 4)}
        assert len(want & have) >= 0.6 * len(want)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute_licence(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in BASE.items():
        key = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(key)] == key]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), words


def check_licences(found, rows):
    want = sorted(str((d, *brute_licence(t)[:5])) for d, t in rows)
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(str(tuple(r[n] for n in names)) for r in found) == want
    for r in found:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert list(filter(None, r["labels"].split(","))) == sorted(set(filter(None, r["labels"].split(","))))


def test_licences_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "...  "), (4, "CC BY cc-by cc, by ccby"), (5, "All rights reserved. ALL RIGHTS RESERVED all rights all rights reserved"),
        (6, "GNU General Public License, version 3"), (7, "Licensed under the Apache License, Version 2.0."), (8, "Released under the MIT License."),
        (9, "Licensed under CC BY-NC 4.0."), (10, "word " * 60000 + "general public license"), (11, "éall rights reserved"), (None, "cc by"), (4, "cc by"),
        (12, "\x00cc\x7fby\x1f cc by"), (13, "the apache license of another kind"), (14, "license " * 500 + "all rights"),
    ]
    found = licences.scan_licences(docs(spark, rows).repartition(4)).collect()
    check_licences(found, rows)
    labels = {r["doc_id"]: r["labels"] for r in found}
    assert labels[7] == "apache-2.0" and labels[8] == "mit" and labels[9] == "cc-by,cc-by-nc" and labels[6] == "gpl,gpl-3.0" and labels[14] == ""
    assert licences.scan_licences(docs(spark, [])).collect() == []


def test_licences_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()]
    check_licences(queries.QUERIES["op9_licences"](spark, LARGER).collect(), rows)


def test_licences_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{LARGER}/documents.parquet'")
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = con.execute(f"select {','.join(names)} from ({queries.ORACLES['op9_licences']})").fetchall()
    found = [tuple(r[n] for n in names) for r in queries.QUERIES["op9_licences"](spark, LARGER).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_licences_of_reworded_notices_match_sql(spark):
    """Template words that stand at their places between foreign words count."""
    rows = [
        (1, "Released through the MIT License."), (2, "It is licensed, per the Apache License, Version 2.0"), (3, "Redistribution x use y source and binary forms, z or q modification"),
        (4, "subject q the terms w the Mozilla Public License, v. 2.0"), (5, "Licensed q CC BY-SA 4.0 and licensed w cc by nc x 0"), (6, "the mit license"), (7, None), (8, "plain words of the day"),
    ]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = con.execute(f"select {','.join(names)} from ({licences.licence_sql()})").fetchall()
    found = [tuple(r[n] for n in names) for r in licences.scan_licences(docs(spark, rows)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    one = (*licences.TEMPLATES, licences.Template("x", "the zlib notice", "zlib"))
    assert [r["labels"] for r in licences.scan_licences(docs(spark, [(1, "a zlib b")]), one, share=0.05).collect()] == ["x"]


def test_licences_are_native(spark):
    plan = queries.QUERIES["op9_licences"](spark, SMALL)._jdf.queryExecution().toString()
    plan += queries.QUERIES["op8_decontamination"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_windows_cover_long_words():
    word = bytes(range(97, 123)) * 9
    found = toxicity.windows(b"Hi " + word + b" 12x")
    assert found[0] == b"hi" and found[-1] == b"x"
    joined, step = b"", toxicity.LONGEST - toxicity.OVERLAP
    for w in found[1:-1]:
        joined += w[:step]
    assert word.startswith(joined) and word.endswith(found[-2]) and all(len(w) <= toxicity.LONGEST for w in found)


def test_toxicity_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 ..."), (4, "the and of " * 30000), (5, "x" * 100000), (None, "you idiot"), (6, "same"), (6, "same")]
    frame = docs(spark, rows)
    none = toxicity.score_documents(frame, None).collect()
    assert len(none) == len(rows) and all(r["score"] == 0 and r["predicted"] == 0 for r in none)
    source, labels = spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet")
    model = toxicity.fit(source, labels)
    found = toxicity.score_documents(frame, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == toxicity.held_out(r["doc_id"]) for r in found)
    kept = toxicity.drop_toxic(frame, model)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in found if r["predicted"] == 0)
    assert toxicity.fit(source.limit(0), labels) is None and toxicity.score_documents(docs(spark, []), model).collect() == []


def test_toxicity_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    found = queries.QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in found if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    hits = sum(p and y for p, y in held)
    assert hits >= 0.5 * sum(y for _, y in held) and hits >= 0.9 * sum(p for p, _ in held)
