"""Toxicity, quality, language and main text: accuracy on rows that were not learned from, and edge cases."""

import random
import re
from html import unescape

import numpy as np
from pyspark.sql import functions as F

from quillset.llm import html_extract, language, quality, toxicity
from quillset.llm.queries import op2_quality, op6_language, op7_html_extract, op9_toxicity

SF = "/root/testdata/sf0.01"
EDGES = [(1, None), (1, ""), (None, "x"), (2, "123 !!"), (3, "Wort " * 20000), (3, "Wort " * 20000)]


def edges(spark, extra):
    return spark.createDataFrame([(*e, "c") for e in EDGES], f"doc_id long, text string, {extra} string")


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op9_toxicity(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.93
    assert op9_toxicity(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_toxicity_learns_pairs():
    rng = random.Random(1)
    rows, y = [], []
    for _ in range(3000):
        terms = [t for t in range(12) if rng.random() < 0.4]
        rows.append(np.array(terms, int))
        y.append(float((0 in terms) == (1 in terms)))  # no single term tells
    y = np.array(y)
    model = toxicity.learn(rows, y, np.arange(12), int(y.sum()), int(len(y) - y.sum()), epochs=60)
    right = [(model.margin(r.tolist()) >= 0) == t for r, t in zip(rows, y)]
    assert np.mean(right) > 0.95


def test_toxicity_edges(spark):
    docs = edges(spark, "score")
    labels = spark.createDataFrame([(1, 1), (3, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 1")):
        got = toxicity.score(docs, toxicity.fit(docs, known)).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op2_quality(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.selected == (r.quality == 1) for r in rows]) >= 0.85
    assert all(0 <= r.expected_grade <= 2 for r in rows)


def test_quality_thresholds_keep_their_order():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 4, 2000)
    numbers = np.where(rng.random(2000) < 0.9, y, rng.integers(0, 4, 2000))
    model = quality.learn(np.arange(2001), numbers, np.ones(2000), y)
    assert (np.diff(model.thresholds) > 0).all()
    assert (np.diff(model.weights[:4]) > 0).all()
    tails = model.tails(model.weights[:4])
    assert (np.diff(tails, axis=1) < 0).all()


def test_quality_edges(spark):
    docs = edges(spark, "expected_grade")
    ratings = spark.createDataFrame([(1, 1), (3, 0), (2, None), (None, 1)], "doc_id long, grade int")
    for known in (ratings, ratings.limit(0), ratings.filter("grade = 1")):
        got = quality.rate(docs, quality.fit(docs, known)).collect()
        assert len(got) == len(EDGES) and all(0 <= r.tail_probability <= 1 for r in got)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op6_language(spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "bab"]
    table = language.PieceTable(pieces)
    chance = np.random.default_rng(1).random((len(pieces) + 1, 2))

    def total(s, k):
        if not s:
            return 1.0
        found = sum(chance[i, k] * total(s[len(p) :], k) for i, p in enumerate(pieces) if s.startswith(p))
        return found + (chance[-1, k] * total(s[1:], k) if s[0] not in pieces else 0)

    words = ["ab", "abab", "baba", "x", "axb", "b" * 40]
    got = language.Lattice.of(words, table).chances(chance)
    assert np.allclose(got, [[total("▁" + w, k) for k in (0, 1)] for w in words])
    one = chance[:, :1]
    counts = np.array([1.0, 2, 3, 1, 1, 1])
    expected, lost = language.Lattice.of(words, table).expected(one, counts)
    assert not lost.any()
    alone = [language.Lattice.of([w], table) for w in words]
    assert np.allclose([x.log_forward(np.log(chance))[-1] for x in alone], np.log(got))
    assert np.allclose(sum(n * x.log_expected(np.log(one)) for x, n in zip(alone, counts, strict=True)), expected)
    small = np.zeros_like(one)
    step = 1e-6
    for i in range(len(one)):  # the expected uses are the slope of the log chance by the log of each piece
        small[:] = one
        small[i] *= 1 + step
        change = np.log(language.Lattice.of(words, table).chances(small)) - np.log(got[:, :1])
        assert np.isclose((change[:, 0] * counts).sum() / step, expected[i], rtol=1e-3, atol=1e-4)


def test_long_pieces_count():
    pieces = language.public_pieces()
    assert {"▁function", "▁information", "▁children"} <= set(pieces)
    table = language.PieceTable(["▁", *"abcdefghijkl", "▁abcdefghijkl"])
    chance = np.full((15, 1), 0.5)
    got = language.Lattice.of(["abcdefghijkl"], table).chances(chance)
    assert np.isclose(got[0, 0], 0.5 + 0.5**13)


def test_long_and_improbable_words_are_summed_whole():
    rng = np.random.default_rng(7)
    pieces = ["▁", *"abcd", "ab", "bcd", "▁ab", "dab", "abcdabcd"]
    words = {k: {"".join(rng.choice(list("abcd"), n)): 2 for n in (3, 60, 200)} for k in ("one", "two")}
    model = language.learn(words, pieces)

    def plain(word, k):
        text, logs = "▁" + word, [0.0]
        for j in range(1, len(text) + 1):
            known = [(i, model.pieces.pieces.index(text[i:j])) for i in range(max(0, j - 8), j) if text[i:j] in pieces]
            known += [(j - 1, len(pieces))] if text[j - 1] not in pieces else []
            logs.append(np.logaddexp.reduce([logs[i] + np.log(model.chance[p, k]) for i, p in known]))
        return logs[-1]

    long_ = ["".join(rng.choice(list("abcd"), n)) for n in (48, 49, 120, 500, 3000)] + ["é" * 48, "abé" * 30, "ab"]
    model.meet(set(long_))
    for w in long_:
        assert np.allclose(model.logs[model.known[w]], [plain(w, k) for k in (0, 1)], rtol=1e-9)
    names, scores = model.predict([long_[3] + " " + long_[0], "é" * 48 + " 12", "12"])
    total = np.array([plain(long_[3], k) + plain(long_[0], k) for k in (0, 1)])
    assert names[0] == model.languages[int(total.argmax())]
    assert np.isclose(scores[0], 1 / np.exp(total - total.max()).sum()) and names[2] == "und"


def test_language_edges(spark):
    docs = edges(spark, "lang").withColumn("score", F.lit("text"))
    got = language.identify(docs, language.fit(docs.withColumn("lang", F.lit("de")))).collect()
    assert [r.lang_pred for r in got].count("und") == 3 and all(0 <= r.score <= 1 for r in got)
    none = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), none).count() == 0


def test_main_text_of_other_labelled_pages():
    field = html_extract.fit()
    pages = [html_extract.labelled_blocks(p) for p in html_extract.labelled_pages(200, seed=99)]
    right = [a == b for blocks, labels in pages for a, b in zip(field.decode(blocks), labels, strict=True)]
    assert np.mean(right) >= 0.99


def test_main_text_of_hand_made_pages():
    field = html_extract.fit()
    page = """<html><head><title>t</title><script>var a = "<p>no</p>";</script></head><body>
    <header><a href=/>Site</a></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
    <div class="cookie-notice">We use cookies.</div>
    <article><h1>The  title &amp; more</h1><p>First <b>bold</b>\n paragraph, of some length.<p>Second one&hellip;
    <div class="ad">Buy now!</div><p>Third &lt;p&gt; here.</p></article>
    <section class="comments"><p>I do not agree with this article.</p></section>
    <form><input name=q> Search <button>Go</button></form><aside>Other news of today</aside>
    <footer>&copy; 2020 Site</footer>"""
    assert field.main_text(page) == "The title & more First bold paragraph, of some length. Second one… Third <p> here."
    assert field.main_text(None) == field.main_text("") == field.main_text("<p") == ""


def test_main_text_with_odd_markup():
    field = html_extract.fit()
    text = "First paragraph of the article, of some length. Second one, and it ends here."
    body = "<p>First paragraph of the article, of some length.</p><p>Second one, and it ends here.</p>"
    for head in (
        "<h1 title=author's>Head</h1>",
        '<h1 data-x="a""b" data-y=\'>\' class = "x > y">Head</h1>',
        "<h1 title = 'it \"is\"'>Head</h1>",
        "<h1 \" '>Head</h1>",
        "<H1\nclass=a/b>Head</H1>",
    ):
        assert field.main_text(f"<body><nav><a href=/>Home</a></nav><article>{head}{body}</article></body>") == f"Head {text}"
    for control in ("<button>Press", "<select><option>One<option>Two", "<button class=btn>Press</button>"):
        page = f"<body><article><h1>Head</h1>{control}{body}</article></body>"
        assert field.main_text(page) == f"Head {text}"
    page = "<article><h1>Head</h1><p>A sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> and <object>an image</object>"
    assert field.main_text(page + "<noscript>, drawn</noscript>.</p></article>") == "Head A sum a+b and an image, drawn."
    assert field.main_text(f"<article><h1>Head</h1>{body}</article") == f"Head {text}"
    assert field.main_text(f"<article><h1>Head</h1>{body}<!-- never closed <p>x</p>") == f"Head {text}"


def test_main_text_of_long_and_broken_pages_is_quick():
    field = html_extract.fit()
    long_ = "<article>" + "<p>Some words of a long article.</p>" * 20_000 + "</article>"
    assert len(field.main_text(long_)) == 20_000 * len("Some words of a long article. ") - 1
    for broken in ("<" * 200_000, "<a " * 100_000, '<a b="' * 50_000, "<!" * 100_000, "</" * 100_000, "=\"" * 100_000):
        field.main_text(broken)
        field.main_text(f"<p>{broken}</p>")


def test_main_text_of_edge_tables(spark):
    field = html_extract.fit()
    rows = [(1, "<article><p>Twice, and long enough to be read.</p></article>", "u", "t")] * 2 + [(None, None, None, None), (2, "", "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, text string")
    got = html_extract.extract(pages, field).collect()
    assert sorted(r.text for r in got) == ["", ""] + ["Twice, and long enough to be read."] * 2
    assert html_extract.extract(pages.limit(0), field).collect() == []


def test_main_text_of_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in op7_html_extract(spark, SF).collect()}
    for p in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", p.html, re.DOTALL)[1]
        parts = re.split(r"<(?:/?p|br|/?h1)[^>]*>", re.sub(r"</?b>", "", inner))
        want = " ".join(x for x in (" ".join(unescape(t).split()) for t in parts) if x)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)
