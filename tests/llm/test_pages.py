"""Main text of pages, URL filter and vector search against plain versions."""

import html
import random
import re
import time

import numpy as np
import pytest

from ledgerloom.llm import html_extraction, url_filter, vector_search
from ledgerloom.llm.html_extraction import Page
from pyspark.sql import functions as F

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="wrap"><%(tag)s><h1>Head &amp; line</h1><p><b>One&nbsp;two
 three.<br><p>Four &lt;five&gt; &#233;.</p><form>Search<input></form><div class="ad">Buy</div>
<ul><li>first<li class="z">second</ul><div class="comments"><p>Reader says</p></div><p>Last.%(more)s</%(tag)s>
<aside>Side</aside></div><footer>&copy; me</footer></body></html>"""
TEXT = "Head & line\nOne two three.\nFour <five> é.\nfirst\nsecond\nLast."


@pytest.mark.parametrize("tag", ["article", "main", 'div class="post-content"'])
def test_main_text_is_the_article_alone(tag):
    source = PAGE.replace("</%(tag)s>", f"</{tag.split()[0]}>") % {"tag": tag, "more": ""}
    assert Page(source).text() == TEXT


def test_open_and_broken_markup():
    assert Page("just text &amp; more").text() == "just text & more"
    assert Page("<p>a<p>b <a href=x>c</a>").text() == "a\nb c"
    assert Page("<nav><a href=x>m</a><article>kept</article>").text() == "kept"
    assert Page("<article>a<script>never closed <p>x").text() == "a"
    assert Page("<article>a<!-- open <p>x").text() == "a"
    assert Page("").text() == "" and Page("<nav>only</nav>").text() == ""
    assert Page("<article>" + "<p>w x</p>" * 50_000).text() == "\n".join(["w x"] * 50_000)


@pytest.mark.parametrize("tag", ["noscript", "template", "object", "svg", "select", "button", "canvas", "audio", "video"])
def test_an_element_without_end_tag_does_not_end_the_page(tag):
    assert Page(f"<article>a<p>b<{tag} class=x>c</{tag}> d<{tag}><p>e</article>").text() == "a\nb d\ne"
    assert Page("<article>" + f"<p>w x<{tag}>" * 20_000).text() == "\n".join(["w x"] * 20_000)


def test_formulas_stay():
    assert Page("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p></article>").text() == "Let x=2 be."


@pytest.mark.parametrize("tag", ["script", "style", "title", "textarea", "iframe"])
def test_raw_text_without_end_tag_ends_the_page(tag):
    assert Page(f"<article>a<{tag}>b <p>c</article>").text() == "a"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<a " * 350_000, ("<a " * 350_000).strip()),
        ("<a" * 500_000, "<a" * 500_000),
        ("</ " * 300_000, ("</ " * 300_000).strip()),
        ('<a "> "' * 150_000 + "w", '" ' * 149_999 + '"w'),
        ("<div class='menu'>" * 60_000 + "w", ""),
        ('<div class="x">w' * 60_000, "\n".join(["w"] * 60_000)),
        ("<div id=story>w " * 60_000, "\n".join(["w"] * 60_000)),
        ("<div>" * 60_000 + "</section>" * 60_000 + "w", "w"),
        ("<div>" * 60_000 + "<nav>m<article>" * 60_000 + "w", "w"),
    ],
)
def test_a_megabyte_of_broken_or_nested_markup_is_read_in_seconds(source, text):
    begin = time.monotonic()
    page = Page(source)
    assert page.text("") == text
    assert time.monotonic() - begin < 30 and max(map(len, page.scores), default=0) <= 1000


def test_quotes_that_are_never_closed_end_tags_as_late_as_they_can():
    rng = random.Random(6)
    for _ in range(2000):
        source = "".join(rng.choice(["<a ", ">", '"', "'", "x", " ", "<b", "</i", "="]) for _ in range(40))
        scanner, place = html_extraction._Scanner(source), 0
        while found := scanner.after(place):
            start, place, _, name, rest = found
            begin = place - 1 - len(rest)
            quoted = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*>""").match(source, begin) if name else None
            assert source[start] == "<" and place == (quoted.end() if quoted else source.index(">", begin) + 1)


def test_paths_of_deep_containers_keep_their_order_and_meet_on_other_pages(spark):
    deep = '<div class="level">' * 400
    pages = [(k, f"http://deep.org/{k}", f'{deep}<div class="story">{"words here " * n}</div><div class="other">{"more words " * 8}</div>') for k, n in enumerate([40] * 8 + [2])]
    got = html_extraction.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {k: ("words here " * n).strip() for k, n in enumerate([40] * 8 + [2])}
    assert {html_extraction._depth(r.path) for r in got} == {400} and all(r.path.startswith("#") for r in got)


PROSE = "<h1>Head</h1><p>" + "Plain words of the story. " * 20 + "</p>"
PROSE_TEXT = "Head\n" + ("Plain words of the story. " * 20).strip()


@pytest.mark.parametrize(
    "around",
    [
        '<div class="layout has-sidebar"><article>%s</article></div>',
        '<div class="sidebar-left"><main>%s</main><div class="sidebar">side</div></div>',
        '<div class="content no-ads">%s</div>',
        '<div class="menu-page content">%s</div><div class="cookie-notice">We use cookies</div>',
        '<form id="aspnetForm"><div class="wrap"><div class="nav">menu</div>%s</div><div class="ad">Buy</div></form>',
        '<form id="aspnetForm"><article>%s<form>Search<input></form></article></form>',
        '<article><div class="share-story">%s</div></article>',
    ],
)
def test_containers_with_a_listed_word_keep_the_main_text(around):
    assert Page(f"<html><body><nav>menu</nav>{around % PROSE}<footer>f</footer></body></html>").text() == PROSE_TEXT


def test_listed_words_beside_the_main_text_are_left_out():
    long = "<p>" + "Readers say very much about it. " * 60 + "</p>"
    for beside in ('<div class="comments"><div class="text">%s</div></div>', '<div id="cookie-consent">%s</div>', '<div class="related"><article>x</article></div><form>%s</form>', '<div class="sidebar"><article class="comment">%s</article></div>'):
        assert Page(f"<body><article>{PROSE}</article>{beside % long if '%s' in beside else beside}</body>").text() == PROSE_TEXT
    assert Page(f'<body><div class="post">{PROSE}</div><div class="comments"><div class="text">{long}</div></div></body>').text() == PROSE_TEXT
    assert Page('<body><div class="cookie-notice">We use cookies</div><form>Search</form></body>').text() == ""


def test_sections_named_by_their_heading_stay():
    sections = '<section id="related-work"><h2>Related work</h2><p>Others did.</p></section><section id="search"><p>We look.</p></section>'
    beside = '<section id="related"><a href="/x">More</a></section><section class="newsletter"><p>Mail</p></section>'
    for around in ("<article>%s</article>", '<div class="post">%s</div>'):
        assert Page(around % f"{PROSE}{sections}{beside}").text() == f"{PROSE_TEXT}\nRelated work\nOthers did.\nWe look."


def test_the_host_decides_where_a_page_alone_would_not(spark):
    usual = '<html><body><div class="story-%d">%s</div><div class="extra">x</div></body></html>'
    odd = '<html><body><div class="story-9">short</div><div class="extra">%s</div></body></html>'
    rows = [(k, f"http://Host.org/{k}", usual % (k, "<p>" + "words here " * 30 + "</p>")) for k in range(9)]
    rows += [(20, "http://host.org/odd?x", odd % ("much more text " * 30)), (21, "http://other.org/", odd % ("much more text " * 30))]
    rows += [(30, None, "<p>no host</p>"), (31, "http://host.org/null", None), (None, "mail", ""), (9, "http://host.org/9", usual % (9, "twice")), (9, "http://host.org/9", usual % (9, "twice"))]
    pages = spark.createDataFrame([(*r, "p", "h", 1) for r in rows], "page_id long, url string, html string, path string, host string, vote int")
    got = html_extraction.extract(pages).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(texts[k] == ("words here " * 30).strip() for k in range(9))
    assert (texts[20], texts[21]) == ("short", ("much more text " * 30).strip())
    assert (texts[30], texts[31], texts[None]) == ("no host", "", "")
    assert sum(r.page_id == 9 and r.text == "twice" for r in got) == 2
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_every_template_of_a_host_has_its_container(spark):
    news = '<html><body><div class="story">%s</div><div class="notes">of the day</div><p>tagline</p></body></html>'
    wiki = '<html><body><div class="story">teaser</div><div class="notes">%s</div><p>tagline</p></body></html>'
    talk = '<html><body><div class="story">%s</div><div class="notes">%s</div></body></html>'
    long = ("words here " * 60).strip()
    pages = [(k, news % long) for k in range(60)] + [(100 + k, wiki % long) for k in range(30)]
    pages += [(200, talk % (long, long + " and some")), (201, "<html><body><table><tr><td>%s</table></body></html>" % long)]
    rows = spark.createDataFrame([(k, f"http://host.org/{k}", source) for k, source in pages], "page_id long, url string, html string")
    assert {r.text for r in html_extraction.extract(rows).collect()} == {long}
    path = {r.page_id: r.path for r in html_extraction.extract(rows).collect()}
    assert path[0].endswith("div.story") and path[100].endswith("div.notes") and path[200].endswith("div.story") and "td" in path[201]


def plain_text(source):
    import re

    found = re.search(r"<article>(.*?)</article>", source or "", re.S)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", found[1])] if found else []
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    from ledgerloom.llm.queries import op2_html_extraction

    folder = "/root/testdata/sf0.001"
    try:
        pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    except Exception:
        pytest.skip("no test tables")
    got = op2_html_extraction(spark, folder).collect()
    assert {r.page_id: r.text for r in got} == {k: plain_text(p.html) for k, p in pages.items()}
    assert all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in got)


# URL filter


def plain_verdict(url, rules):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in next(iter(__import__("re").split(r"[/?#]", after))))
    path = __import__("re").split(r"[?#]", after[len(host) :])[0]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow" if host else "block"))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "https://a.net", "https://a.net/", "http://net/x", "HTTP://EXAMPLE.NET/en/1", "http://m.example.net/en/2?q",
    "http://m.example.net/enx", "http://notexample.net/en/", "http://example.com/de/", "http://a.b.example.com/de/x#y", "http://example.com/DE/x",
    "https://x.org/fr/", "https://org/fr/1", "https://x.org?y=/fr/", "ftp://x.org#/fr/", "http://a..net/x", "http://example.net:80/en/", "http://é.net/ü",
    "http://x://y.net/", "http://net./x",
]


@pytest.mark.parametrize("seed", [None, 4])
def test_verdicts_equal_trying_every_rule(spark, seed):
    rules, urls = url_filter.RULES, [*URLS, *URLS, *["http://hot.example.net/en/same"] * 60]
    if seed:
        rng = random.Random(seed)
        hosts = ["net", "example.net", "a.example.net", "com", "example.com", "org"]
        paths = ["/", "/a", "/a/", "/a/b", "/ab", "/b/", ""]
        rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h, p in ((rng.choice(hosts), rng.choice(paths)) for _ in range(25))}.values())
        urls += [f"http://{rng.choice(['', 'm.', 'x.y.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'b', '/', '?a', 'b/c'])}" for _ in range(300)]
    pages = spark.createDataFrame([(k, u, "h", "k", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, key string, part int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got == {k: plain_verdict(u, rules) for k, u in enumerate(urls)}
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow", "block"}


def test_hosts_of_many_labels(spark):
    host = "x." * 50_000 + "example.net"
    pages = spark.createDataFrame([(k, f"http://{host}/en/{k}") for k in range(3)] + [(3, "http://" + "." * 50_000)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages).select("page_id", "rule", "verdict").collect()}
    assert got == {0: ("example.net/en/", "allow"), 1: ("example.net/en/", "allow"), 2: ("example.net/en/", "allow"), 3: (None, "allow")}


# Vector search


@pytest.mark.parametrize("at_once", [1024, 3])
def test_top_k_equals_all_inner_products(spark, at_once):
    rng = np.random.default_rng(2)
    vectors = [(k, rng.normal(0, 0.3, 16).tolist()) for k in range(300)]
    vectors += [(1000 + k, vectors[50][1]) for k in range(30)] + [(7, vectors[8][1]), (100, vectors[3][1])]
    vectors += [(2000, None), (2050, [None] * 16), (2100, [float("nan")] * 16), (2150, [float("inf")] * 16), (2200, [1e300] * 16), (2250, []), (2300, [1.0, 2.0]), (2301, [0.5, 1.0])]
    vectors += [(None, vectors[0][1])]
    df = spark.createDataFrame([(i, v, 1, "s", 0) for i, v in vectors], "vec_id long, embedding array<double>, rank int, label string, score int")
    df = df.withColumn("vector", vector_search.quantised(F.col("embedding")))
    got = vector_search.top_k(df, df.where("vec_id % 50 = 0"), 5, at_once).collect()
    known = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors if i is not None and v is not None and i not in (2050, 2100, 2150, 2200)]
    expected = []
    for q in sorted({i for i, _ in known if i % 50 == 0}):
        own = min(v for i, v in known if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in known if i != q and len(v) == len(own))
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)
    assert vector_search.top_k(df.limit(0), df.limit(0)).count() == 0


def test_large_vectors_take_part(spark):
    vectors = [(0, [1e7, 0.5, 0.0, 0.0]), (1, [-1e7, 0.25, 0.0, 0.0]), (2, [9e6, 0.0, 1.0, 0.0]), (3, [0.5, 0.5, 0.5, 0.5])]
    vectors += [(50, [2.0**26, 2.0**26, 1.0, 0.0, 0.0]), (51, [2.0**26, -(2.0**26), 0.5, 0.0, 0.0]), (52, [0.0, 0.0, 2.0, 0.0, 0.0])]

    def found(vectors):
        df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("vector", vector_search.quantised(F.col("embedding")))
        return [(r.query_id, r["rank"], r.vec_id, r.score) for r in vector_search.top_k(df, df.where("vec_id % 50 = 0")).collect()]

    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in vectors}
    expected = []
    for q in (0, 50):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        expected += [(q, k + 1, i, -score) for k, (score, i) in enumerate(scores)]
    assert sorted(found(vectors)) == expected
    with pytest.raises(Exception, match="does not fit 64 bits"):
        found([*vectors, (4, [1e8, 0.0, 0.0, 0.0])])


def test_bounds_are_never_below_the_score():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-200, 200, (50, 19)).astype(float), rng.integers(-200, 200, (60, 19)).astype(float)
    for segments in (1, 4, 16, 19, 40):
        bound = vector_search.segment_statistics(a, segments) @ vector_search.segment_statistics(b, segments).T
        assert (bound >= a @ b.T - 1e-6).all()
