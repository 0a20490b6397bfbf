import html as entities
import re

import pyarrow.parquet as pq
import pytest

from limpid.llm.html import extract, learned, main_text, parse

DATA = "/root/testdata/sf0.01/pages.parquet"
GOOD = "The bridge was opened again on Monday, after two years of work, and many came to see it."


def plain(page):
    """The article's blocks by a pattern; enough for the test table."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(entities.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_as_the_article_of_every_page(spark):
    pages = {r["page_id"]: r for r in pq.read_table(DATA).to_pylist()}
    got = extract(spark.read.parquet(DATA)).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id]["url"] and r.text == plain(pages[r.page_id]["html"]) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "part",
    [
        '<div class="sidebar"><p>Most read: ten ways to save, in our list.</p></div>',
        "<form><p>Write to us, we read every letter.</p></form>",
        '<div class="cookie-notice"><p>We use cookies, as you know.</p></div>',
        '<section class="comments"><p>I was there, and it was grand, I must say.</p></section>',
        "<aside><p>More of this, and of that, on page two.</p></aside>",
        '<div class="ad"><p>Buy one, get one free, today only.</p></div>',
        "<nav><a href=x>Home</a> <a href=y>News</a></nav>",
        "<footer>&copy; The paper, the town.</footer>",
        "<script>var a = '<p>x</p>';</script><style>p{}</style><!-- <p>no</p> -->",
    ],
)
def test_parts_around_and_inside_go(part):
    model = learned()
    body = f"<h1>Bridge</h1><p>{GOOD}</p>"
    want = f"Bridge\n{GOOD}"
    assert main_text(f"<html><body>{part}<article>{body}</article></body></html>", model) == want
    assert main_text(f"<html><body><article>{body}</article>{part}</body></html>", model) == want
    assert main_text(f"<body><article>{body}{part}<p>{GOOD}</p></article></body>", model) == f"{want}\n{GOOD}"


def test_marginals_as_by_all_labellings():
    model = learned()
    import itertools
    import math

    from limpid.llm.html import features, kind

    nodes = parse("<div class=ad><p>a, b</p></div><article>c<b>d</b></article>")
    total, on = 0.0, [0.0] * len(nodes)
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        w = model.root[labels[0]]
        for v, y in zip(nodes[1:], labels[1:], strict=True):
            w += y * sum(model.odds.get(f, 0) for f in features(v)) + model.pair[kind(v)][2 * labels[v.parent] + y]
        total += math.exp(w)
        on = [a + math.exp(w) * y for a, y in zip(on, labels, strict=True)]
    assert model.marginals(nodes) == pytest.approx([a / total for a in on])


def test_edges(spark):
    article = lambda x: f"<body><article><h1>T, one.</h1><p>{GOOD}</p><p>{x}</p></article></body>"
    rows = [(0, "u", None), (1, None, ""), (2, "u", "plain < text"), (3, "u", article("a&amp;b &lt;p&gt;\n\t c<b>d</b>e")), (4, "u", article("word, " * 50_000)), (None, None, "<p"), (3, "u", article("&#233;&nbsp;x<br>y"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS n_chars", "'x' AS text")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in extract(df).collect()), key=str)
    text = {k: [t for i, t, _ in got if i == k] for k in (0, 1, 3, 4)}
    assert text[0] == [""] and text[1] == [""]
    assert sorted(t.split("\n")[-1] for t in text[3]) == ["a&b <p> cde", "é x y"]
    assert text[4][0].endswith("word,") and len(text[4][0]) > 290_000
    assert all(n == len(t) for _, t, n in got)
    assert extract(df.limit(0)).collect() == []
    assert main_text("<div>" * 3000 + "x", learned()) is not None


@pytest.mark.parametrize(
    "inner, want",
    [
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be a number.</p>", "Let x=2 be a number."),
        ("<p>See <svg><text>Fig. 1</text></svg> and <object>the film</object>.</p>", "See Fig. 1 and the film."),
        ("<noscript><p>The picture shows the bridge, as it was.</p></noscript>", "The picture shows the bridge, as it was."),
        ('<p><a href="/r">Read the whole report of the council</a></p>', "Read the whole report of the council"),
        ('<ul><li><a href="/1">The report in full</a></li><li><a href="/2">Minutes</a></li></ul>', "The report in full\nMinutes"),
        ('<p>A <my-term>new word</my-term> here, and <font color=red>red</font>.</p>', "A new word here, and red."),
        ("<p title=it's>One, two.</p>", "One, two."),
        ("<p title='a > b' class=\"x\">One, two.</p>", "One, two."),
        ("<!--> <p>One, two.</p>", "One, two."),
        ("<p>&#" + "9" * 5000 + "; one, two.</p>", "\ufffd one, two."),
    ],
)
def test_nothing_else_is_dropped(inner, want):
    page = f"<html><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>Bridge</h1><p>{GOOD}</p>{inner}<p>{GOOD}</p></article></body></html>"
    assert main_text(page, learned()) == f"Bridge\n{GOOD}\n{want}\n{GOOD}"


@pytest.mark.parametrize(
    "part",
    ["<a ", '<p title="x ', "<div>", "<b>", "<ul><li>", "</div>", "<!-", "<script", "<head>", "<table><tr><td>", "&amp", "<p a='", "<x/", "= \"", "<li></li>", "<a>x"],
)
def test_a_megabyte_of_anything_takes_seconds(part):
    import time

    model = learned()
    page = "<div>" * 2000 + f"<article><p>{GOOD}</p></article>" + part * ((1 << 20) // len(part))
    began = time.process_time()
    main_text(page, model)
    assert time.process_time() - began < 20
    times = []
    for n in (1 << 16, 1 << 18):
        began = time.process_time()
        parse(part * (n // len(part)))
        times.append(time.process_time() - began)
    assert times[1] < 10 * times[0] + 0.2  # four times the page, not sixteen times the time
