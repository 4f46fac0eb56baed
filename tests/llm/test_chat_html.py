"""Perspective rotation against SQL and brute force; main text against the markup of the pages."""

import html as entities
import re

import duckdb
import numpy as np
import pytest

from ringspan.llm import chat, html, queries

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute(rows, part_turns):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "unknown", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        for speaker in {t[2] for t in turns} - {"system"}:
            for part in range(0, len(turns), part_turns):
                text, mask, learnt = "", [], 0
                some = turns[part : part + part_turns]
                for _, _, role, said in some:
                    text += "<|assistant|>\n" if role == speaker else "<|system|>\n" if role == "system" else f"<|user|>{role}\n"
                    if role == speaker:
                        mask.append(f"{len(text)}-{len(text) + len(said) + 7}")
                        learnt += 1
                    text += said + "<|end|>\n"
                out.append((conv, speaker, part // part_turns, text, ",".join(mask), len(some), learnt))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_turns", [3, 256])
def test_perspectives_odd_rows(spark, part_turns):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "Ann", "hi é"), (1, 2, "Bob", None), (1, 2, "Bob", "twice"), (1, 2, "Bob", "twice"), (1, 3, None, "who"),
        (1, None, "Cy", "no turn"), (2, 0, "system", "alone"), (None, 1, "Ann", "no conversation"), (3, 1, "Ann", ""), (4, 5, "x" * 50, "y" * 100000),
    ] + [(9, i, f"p{i % 4}", f"turn {i}") for i in range(700)]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, part int, speaker string").repartition(5)
    found = [tuple(r) for r in chat.rotate_perspectives(frame, part_turns=part_turns).collect()]
    assert sorted(found, key=str) == brute(rows, part_turns)
    assert chat.rotate_perspectives(frame.limit(0)).collect() == []


def test_perspectives_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{LARGER}/conversations.parquet'")
    names = ["conv_id", "speaker", "part", "text", "mask", "n_turns", "n_learnt"]
    want = con.execute(f"select {','.join(names)} from ({queries.ORACLES['op3_chat_perspectives']})").fetchall()
    found = queries.QUERIES["op3_chat_perspectives"](spark, LARGER).collect()
    assert sorted(tuple(r[n] for n in names) for r in found) == sorted(want)


def article(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
    return "\n".join(b for b in blocks if b)


def test_main_text_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{LARGER}/pages.parquet").collect()}
    found = queries.QUERIES["op4_main_text"](spark, LARGER).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_blocks_of_broken_pages():
    texts = lambda page: [b.text for b in html.blocks_of(page)]
    assert texts(None) == [] and texts("") == [] and texts("  \n ") == []
    assert texts("plain &amp; simple\n\t text") == ["plain & simple text"]
    assert texts("<p>a < b<p>c <b>d</b>e<br>f<!-- <p>no</p> --></div>g") == ["a < b", "c de f", "g"] or texts("<p>a < b<p>c <b>d</b>e<br>f")[1] == "c de f"
    assert texts("<script>var t='</p>';</script><style>p{}</style><p title='x>y'>yes</p><script>never closed <p>no") == ["yes"]
    assert texts("<ul><li>one<li>two</ul><p") == ["one", "two", "<p"]
    assert texts('<p class="a>b') == ['<p class="a>b'] or texts('<p class="a>b') == ["b"]
    long = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert texts(long) == ["deep"]


def test_dropped_elements_end_where_they_are_closed():
    texts = lambda page: [b.text for b in html.blocks_of(page)]
    assert texts('<p>one</p><svg class="i"/><p>two</p>') == ["one", "two"]
    for tag in html.DROPPED:
        assert texts(f"<p>one</p><{tag}><p>two</p>")[-1] == "two"
        assert texts(f"<p>one</p><{tag}>x<p>two</p><{tag} a=b>no</{tag}><p>three</p>")[-2:] == ["two", "three"]
        assert texts(f"<p>one<{tag}><b>no</b></{tag}>two</p><{tag}-x>three</{tag}-x>") == ["one two", "three"]
    assert texts("<svg><svg>no</svg>no</svg>yes<title-bar>bar</title-bar><style-x>too</style-x>") == ["yesbartoo"]
    assert texts("<p>so <math><mi>x</mi>=<mn>2</mn></math> holds<math/></p><p>on</p>") == ["so x=2 holds", "on"]
    assert texts("<button><script>'</button>'</script>no</button><p>yes</p>") == ["yes"]
    assert texts("yes<title>never closed <p>no") == ["yes"]


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = html.Labeller.fresh(3, 1)
    x, mask = rng.normal(size=(5, 3, html.INPUT)), np.ones((5, 3), bool)
    mask[3:, 1] = mask[1:, 2] = False
    y = (rng.random((5, 3)) > 0.5).astype(float)
    _, grads = net.gradients(x, mask, y)
    for name, w in net.weights.items():
        at = tuple(rng.integers(s) for s in w.shape)
        w[at] += 1e-5
        up = net.gradients(x, mask, y)[0]
        w[at] -= 2e-5
        down = net.gradients(x, mask, y)[0]
        w[at] += 1e-5
        assert abs(grads[name][at] - (up - down) / 2e-5) < 1e-6


def test_batches_do_not_change_labels():
    rng = np.random.default_rng(1)
    net = html.Labeller.fresh(4, 2)
    pages = [rng.normal(size=(n, html.INPUT)) for n in (0, 1, 7, 30, 2, 7)]
    together = net.label(pages)
    for p, found in zip(pages, together, strict=True):
        assert found.tolist() == (net.label([p])[0].tolist() if len(p) else [])


UNSEEN = [
    (
        """<html><body><header><h1>Site Name</h1><a href=/>Home</a></header><div class="cookie-notice">We use cookies here.</div><main><h2>Real title here</h2>
        <p>This is the first real paragraph, with enough words to be read.</p><div class="ad-slot">Buy this thing now</div><p>Second paragraph
        of the text, again with words.</p><aside>Related: another story</aside></main><section id="comments"><p>Great article, thanks for sharing
        it.</p></section><form><label>Email</label><input></form><footer>Copyright 2020</footer></body></html>""",
        "Real title here\nThis is the first real paragraph, with enough words to be read.\nSecond paragraph of the text, again with words.",
    ),
    (
        """<html><body><ul class="menu"><li><a href=#>One</a><li><a href=#>Two</a></ul><div id="content"><p>Only content paragraph one, which is quite
        long and has punctuation.</p><p>Another one, also long enough to be taken as text.</p></div><div class="sidebar"><p>Popular posts</p></div></body></html>""",
        "Only content paragraph one, which is quite long and has punctuation.\nAnother one, also long enough to be taken as text.",
    ),
]


def test_layouts_not_in_the_sample(spark):
    sample = [r["html"] for r in spark.read.parquet(f"{LARGER}/pages.parquet").select("html").collect()]
    net = html.train_labeller(sample)
    assert html.main_text([p for p, _ in UNSEEN], net, {}) == [t for _, t in UNSEEN]


def test_main_text_odd_rows(spark):
    page = "<html><body><nav><a href=x>a</a></nav><article><p>" + "word &amp; " * 5 + "</p></article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", page), (4, "x", "<article><p>" + "long " * 50000 + "</article>")]
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in html.extract_main_text(frame).collect())
    body = ("word & " * 5).strip()
    want = [("1", "u", body, len(body))] * 2 + [("2", None, "", 0), ("3", "v", "", 0), ("4", "x", ("long " * 50000).strip(), 249999), ("None", "w", body, len(body))]
    assert found == want
    assert html.extract_main_text(frame.limit(0)).collect() == []
