"""Operators over pages: main text, URL rules, languages."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from slotledger.llm.html_text import extract_text, main_text
from slotledger.llm.language import declared_language, fit, identify
from slotledger.llm.mincut import label
from slotledger.llm.url_rules import judge_urls
from tests.llm.conftest import ordered

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; T</title><style>p{}</style>
<script>var t="</p><article>";</script></head><body class="nav-open">
<header class="site-header"><h1>My Site</h1><a href=/>Home</a></header><nav><ul><li><a href="/a">a</a></li></ul></nav>
<div id=cookie-notice><p>We use cookies to make this long site better for you, dear reader.</p></div>
<div class="wrap"><article><header><h1>The   title</h1></header>
<p><b>First &lt;b&gt; paragraph&nbsp;is long enough, with commas, and a full stop.<br>
<p>Short.</p><!-- <p>not here</p> --><div class="advert">Buy now, this is a great product for all of you.</div>
<p>Second has <a href="x>y">a link</a> in\n it &copy; more.</p><ul><li>one point</li><li>two</li></ul></article>
<section id="comments"><article class="comment"><p>Great article, I liked it very much, thank you.</p></article></section>
<aside><p>Related things you may like, a long text that goes on and on.</p></aside>
<form><label>Mail</label><input></form></div><footer>&copy; me</footer></body></html>"""

MAIN = """The title
First <b> paragraph is long enough, with commas, and a full stop.
Short.
Second has a link in it © more.
one point
two"""


def test_main_text_of_a_page():
    assert main_text(PAGE) == MAIN


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>", ""),
        ("<article><p>Kept to the end &am", "Kept to the end &am"),
        ("<article><p>Cut tag</p><foo", "Cut tag"),
        ("<article><p>Cut script</p><script>var a = 1; <p>no</p>", "Cut script"),
        ("<article><p>Open comment</p><!-- <p>no</p>", "Open comment"),
        ("<article><p>a < b and 1 &lt; 2</p></article>", "a < b and 1 < 2"),
        ("</p></div><article><h2>Ümlaut</h2></article>", "Ümlaut"),
        ("<article>" + "<p>A long page, said the parser.</p>" * 3000, "\n".join(["A long page, said the parser."] * 3000)),
        ("<article>" + "<div>" * 2000 + "Deep down it is, deep down.", "Deep down it is, deep down."),
    ],
)
def test_broken_and_long_pages(page, text):
    assert main_text(page) == text


LONG = "This paragraph is long enough to be prose, says everyone who has read it."


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>super<wbr>cali<img src=x>fragi<input type=hidden>listic it is.</p>", "supercalifragilistic it is."),
        ("<article><p>So <math><mi>x</mi> = <mn>2</mn></math> holds.</p>", "So x = 2 holds."),
        (f"<article><datalist><option>a<option value=b>b</datalist><p>{LONG}</p></article>", LONG),
        (f"<article><div><button>Press</div><p>{LONG}</p></article>", LONG),
        (f"<article><select><option>a<option>b</select><p>{LONG}</p></article>", LONG),
        (f"<article><p it's>{LONG}</p><p>It isn't over: {LONG}</p></article>", f"{LONG}\nIt isn't over: {LONG}"),
        (f"<article><p title=\"a > b\" x='>'>{LONG}</p></article>", LONG),
        (f"<article><a href=\"never closed>{LONG}</a></article>", LONG),
        (f'<div class="entry-content has-sidebar"><p>{LONG}</p></div>', LONG),
        (f'<article class="related-post"><p>{LONG}</p></article>', LONG),
        (f'<div class="recipe cookies"><h1>Cookies</h1><p>{LONG}</p></div>', f"Cookies\n{LONG}"),
        (f'<article class="post comments-open" data-id="sidebar"><p>{LONG}</p></article>', LONG),
        (f'<article><p>{LONG}</p><p>{LONG}</p><div class="entry-footer"><p>Posted by me in things.</p></div></article>', f"{LONG}\n{LONG}"),
        (f'<article><p>{LONG}</p></article><div id="comment-content"><p>{LONG}</p></div>', LONG),
        (f'<article><p>{LONG}</p><p>{LONG}</p></article><aside><article><p>{LONG}</p></article></aside>', f"{LONG}\n{LONG}"),
    ],
)
def test_markup_and_names_that_mislead(page, text):
    assert main_text(page) == text


def test_pages_with_mixed_names():
    """Articles under names that also occur on boilerplate are kept whole, and boilerplate goes."""
    draw = random.Random(8)
    words = [w for w in LONG.lower().strip(".").split()] + "river stone winter garden letter candle mountain".split()

    def prose(count):
        return " ".join(draw.choices(words, k=count)).capitalize() + "."

    mains = ['article class="{}"', 'div class="entry-content {}"', 'main id="{}-page"', 'div id="story" class="with-{}"']
    edges = ['div class="{}"', 'section id="site-{}"', 'div class="box {}-box"', 'ul class="main-{}"']
    names = "sidebar newsletter cookies related share notice banner search".split()
    kept = planted = dropped = noise = 0
    for _ in range(300):
        body = [prose(draw.randint(12, 60)) for _ in range(draw.randint(3, 8))]
        around = [prose(draw.randint(3, 14)) for _ in range(draw.randint(2, 5))]
        main, name = draw.choice(mains), draw.choice(names)
        html = "".join(f"<{(e := draw.choice(edges)).format(draw.choice(names))}><p>{t}</p></{e.split()[0]}>" for t in around)
        opening = main.format(name)
        page = f"<body class='{name}'>{html}<{opening}>{''.join(f'<p>{t}</p>' for t in body)}</{opening.split()[0]}></body>"
        found = main_text(page).split("\n")
        planted, noise = planted + len(body), noise + len(around)
        kept += sum(t in found for t in body)
        dropped += sum(t not in found for t in around)
    assert kept >= 0.99 * planted and dropped >= 0.99 * noise, (kept / planted, dropped / noise)


def test_extract_text_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article><p>Ünï 🎉.</p></article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("x"))
    expected = [(1, "u", MAIN, len(MAIN))] * 2 + [(2, None, "", 0), (None, "v", "Ünï 🎉.", 6)]
    assert ordered(tuple(r) for r in extract_text(pages).collect()) == ordered(expected)
    assert extract_text(pages.limit(0)).count() == 0


def test_labels_are_of_least_cost():
    draw = random.Random(5)
    for _ in range(300):
        n = draw.randint(1, 8)
        pull = [draw.choice([-3, -1, -0.5, 0.5, 1, 3]) for _ in range(n)]
        ties = [(i, j, draw.choice([0.3, 0.7, 2])) for i in range(n) for j in range(i) if draw.random() < 0.5]

        def cost(labels):
            return sum(abs(p) for p, x in zip(pull, labels) if (p > 0) != x) + sum(
                w for i, j, w in ties if labels[i] != labels[j]
            )

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(label(pull, ties)) - best) < 1e-9


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("example.com", "/en/", "allow"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("b.net", "/", "allow"),
    ("example.com", "/en/deep/er/", "allow"),
]
URLS = [
    "http://www.example.com/en/1", "https://EXAMPLE.com/en/1?x=/en/", "http://a.b.example.com/en/deep/er/x", "x",
    "http://a.net/es/1", "http://b.net/es/1", "http://b.net", "http://com/", "http://xcom/", "ftp://example.com.#/en/",
    None, "", "://", "http://example.com/EN/", "http://www.example.com/en", "http://ünï.com/ä", "http://b.net/" + "y" * 9000,
]


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_url_rules(spark, partitions):
    urls = [(i, u) for i, u in enumerate(URLS)] + [(50 + i, URLS[2]) for i in range(40)] + [(0, URLS[0]), (None, URLS[4])]
    pages = spark.createDataFrame(urls, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    expected = []
    for page, url in urls:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = rest[:end].lower(), rest[end:].split("?")[0].split("#")[0]
        fits = [
            (len(h) + len(p), len(h), h + p, v)
            for h, p, v in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, 0, None, "allow"))
        expected.append((page, host, path, best[2], best[3]))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert ordered(tuple(r) for r in judge_urls(pages, rules).collect()) == ordered(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert judge_urls(pages, rules.limit(0)).filter("verdict <> 'allow' OR rule IS NOT NULL").count() == 0


def test_languages_on_held_out_rows(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    held_out = F.col("doc_id") % 3 == 0
    languages, model = fit(documents.filter(~held_out), "doc_id", "text", "lang")
    assert languages[-1] == "und" and set(languages[:-1]) == {"en", "de", "fr", "es"}
    rows = documents.filter(held_out).select(
        F.col("doc_id").alias("id"), "text", F.lit(None).cast("string").alias("declared"), F.col("source").alias("host")
    )
    truth = {r.doc_id: r.lang for r in documents.collect()}
    found = identify(rows, languages, model).collect()
    assert len(found) == rows.count()
    assert sum(truth[r.id] == r.lang for r in found) >= 0.98 * len(found)


def test_declared_language_and_host_decide_short_texts(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    languages, model = fit(documents, "doc_id", "text", "lang")
    german = [r.text for r in documents.filter("lang = 'de'").limit(20).collect()]
    english = [r.text for r in documents.filter("lang = 'en'").limit(20).collect()]
    rows = [(i, t, "de", "www.a.de") for i, t in enumerate(german)] + [(100 + i, t, "en", "b.com") for i, t in enumerate(english)]
    rows += [(200, "x", "de", "www.a.de"), (201, "x", "en", "b.com"), (202, "x", None, "new.de"), (202, "x", None, "new.de")]
    rows += [(203, None, None, None), (204, "", "en", "b.com"), (205, "123 !!", "de", None), (206, "der " * 100_000, None, None)]
    frame = spark.createDataFrame(rows, "id bigint, text string, declared string, host string").withColumn("soft", F.lit(1))
    found = identify(frame, languages, model).collect()
    assert len(found) == len(rows)
    by_id = {r.id: r for r in found}
    assert (by_id[200].lang, by_id[201].lang, by_id[202].lang) == ("de", "en", "de")
    assert [by_id[i].accepted for i in (203, 204, 205, 206)] == [False, False, False, True]
    assert identify(frame.limit(0), languages, model).count() == 0


def test_every_label_is_fitted(spark):
    """More labels than 64, one of them rare in a table far larger than the sample."""
    def text(label, row):
        return " ".join(f"{chr(97 + label // 26)}{chr(97 + label % 26)}{x}" for x in ("qo", "ve", "ru")[row % 3 :] + ("li",))

    rows = [(k * 100 + i, f"{text(k, i)} " * 20, f"l{k:02}") for k in range(70) for i in range(2)]
    rows += [(100_000 + i, text(80, i), "big") for i in range(30_000)]
    rows += [(None, text(90, 0), "null-ids"), (7, None, "no-text"), (8, "12", "no-letters")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    languages, model = fit(frame, "doc_id", "text", "lang", label_rows=1)
    assert languages == ["big", *(f"l{k:02}" for k in range(70)), "null-ids", "und"]
    few = [(k, text(k, 0) + " " + text(k, 1), None, None) for k in range(70)]
    asked = spark.createDataFrame(few, "id bigint, text string, declared string, host string")
    languages, model = fit(frame, "doc_id", "text", "lang")
    found = {r.id: r.lang for r in identify(asked, languages, model).collect()}
    assert found == {k: f"l{k:02}" for k in range(70)}


def test_without_labels_all_is_unknown(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    languages, model = fit(empty, "doc_id", "text", "lang")
    rows = spark.createDataFrame([(1, "some text", None, None)], "id bigint, text string, declared string, host string")
    found = identify(rows, languages, model).collect()
    assert [(r.lang, r.accepted) for r in found] == [("und", False)]


def test_declared_language(spark):
    pages = [('<html lang="de-AT">',), ("<HTML LANG=fr>",), ("<html class='x' lang='en'>",), ("<p lang=es>",), (None,)]
    frame = spark.createDataFrame(pages, "html string").select(declared_language("html").alias("l"))
    assert [r.l for r in frame.collect()] == ["de", "fr", "en", None, None]
