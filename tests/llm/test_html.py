import html
import random
import re

import duckdb
import pytest

from ..conftest import SF_SMALL
from vaxmart.llm import html_extract, html_wrapper, registry

SCHEMA = "page_id long, url string, html string, host string, text int, labels string"


def extract(spark, rows):
    df = spark.createDataFrame([(i, u, h, "x", 1, "l") for i, (u, h) in enumerate(rows)], SCHEMA)
    return {r["page_id"]: r for r in html_extract.extract(df).collect()}


def texts(spark, sources, url="http://h.example/"):
    got = extract(spark, [(url, s) for s in sources])
    assert sorted(got) == list(range(len(sources)))
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    return [got[i]["text"] for i in range(len(sources))]


def plain(source):
    """The test tables' article, read with plain patterns."""
    inside = re.search(r"<article>(.*)</article>", source or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", inside[1]) if inside else []
    found = [" ".join(html.unescape(re.sub(r"</?\w+[^>]*>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for b in blocks]
    return "\n".join(t for t in found if t)


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01"])
def test_tables(spark, sf):
    pages = {i: (u, h) for i, u, h in duckdb.sql(f"SELECT page_id, url, html FROM '{sf}/pages.parquet'").fetchall()}
    rows = registry.QUERIES["op13_html_extraction"](spark, sf).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        url, source = pages[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (url, plain(source), len(plain(source)))


ARTICLE = "<article><header><h1>Title</h1></header><p>First &amp; <b>bold</b>\n text<p>Second&nbsp;one<ul><li>a<li>b</ul>{}</article>"
WANT = "Title\nFirst & bold text\nSecond one\na\nb"


@pytest.mark.parametrize("extra", [
    "<div class='ad'>Buy</div>", "<aside>Side</aside>", "<section id=comments><h2>Comments</h2><article class=comment>nice</article></section>",
    "<script>var t='</p>x';</script>", "<style>p{}</style>", "<form><label>Name</label><input><button>Send</button></form>", "<!-- <p>no</p> -->",
    "<div class='share-buttons'><a href=x>Tweet</a></div>", "<noscript>on</noscript>", "<div hidden>never</div>", "<p style='display: none'>never</p>",
    "<div class='cookieNotice'>We use</div>", "<ol class='commentlist'><li>me</li></ol>", "<footer>Filed</footer>", "<nav><a href=x>next</a></nav>",
    "<select><option>one</select>", "<svg><text>pic</text></svg>"])
def test_parts_beside_the_article(spark, extra):
    page = "<!DOCTYPE html><html><head><title>T</title></head><body class='has-sidebar'><header><h1>Site</h1></header><nav><ul><li>x</ul></nav>{}{}</body>"
    other = page.format(ARTICLE.format(""), "<footer>f</footer>")
    assert texts(spark, [page.format(ARTICLE.format(extra), ""), page.format(ARTICLE.format(""), extra), other]) == [WANT] * 3


def test_pages_without_article(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    bodies = [[" ".join(word() for _ in range(40)) for _ in range(rng.randrange(1, 5))] for _ in range(12)]
    pages = [f"<html><body><div>My Site</div><div><a href=1>{word()}</a> <a href=2>{word()}</a></div><div class=content>"
             + "".join(f"<p>{t}</p>" for t in b) + "</div><div class=sidebar><p>Links</p></div><div>All rights reserved</div></body></html>" for b in bodies]
    assert texts(spark, pages) == ["\n".join(b) for b in bodies]
    main = "<body><div>menu words</div><main><h2>Head</h2><table><tr><td>1<td>2</table></main><div>end</div>"
    assert texts(spark, [main]) == ["Head\n1\n2"]
    for source, text in (("just text, 1 < 2 &lt; 3", "just text, 1 < 2 < 3"), ("<form><p>all of it is a form</p></form>", "all of it is a form")):
        assert texts(spark, [source]) == [text]


def test_odd_pages(spark):
    rows = [(None, None), ("", ""), ("no scheme", "<p>a</p>"), ("http://A.b/x", "<article><p>cut <b"), ("http://a.B?y", "<article>one<br>two</article>"),
            ("http://a.b#z", "<p " + "a='<' " * 4000 + ">long</p>"), ("http://deep/", "<div>" * 5000 + "deep" + "</div>" * 10),
            ("http://q/", "<a title=\"x>y'>t</a>" * 50), ("http://w/", "<p>" + "word " * 60000), ("http://e/", "<title>open"), ("http://s/", "</p></div>s</b>")]
    got = extract(spark, rows * 2)
    assert len(got) == 2 * len(rows)
    assert [got[i]["text"] for i in (0, 1, 2, 3, 4, 5, 6, 9, 10)] == ["", "", "a", "cut", "one two", "long", "deep", "", "s"]
    assert got[8]["n_chars"] == 60000 * 5 - 1 and all(got[i]["text"] == got[i + len(rows)]["text"] for i in range(len(rows)))
    assert extract(spark, []) == {}


def test_many_streams_and_shuffled_labels(spark, monkeypatch):
    """Rounds of partial wrappers, and labels joined by a shuffle, give what one round and a broadcast give."""
    rng = random.Random(5)
    tags = ["p", "h2", "blockquote", "pre"]
    bodies = [[(rng.choice(tags), f"text {i} {k}") for k in range(rng.randrange(1, 9))] for i in range(60)]
    pages = [f"<body><nav>n</nav><div class=ad>x</div><article>{''.join(f'<{t}>{x}</{t}>' for t, x in b)}</article><footer>f</footer>" for b in bodies]
    want = ["\n".join(x for _, x in b) for b in bodies]
    assert texts(spark, pages) == want
    monkeypatch.setattr(html_extract, "FAN", 4)
    monkeypatch.setattr(html_extract, "BROADCAST_STREAMS", 0)
    assert texts(spark, pages) == want


def test_patterns():
    def items(source):
        return html_wrapper.Page(source).items

    assert html_wrapper.pattern(items("<ul><li>a<li>b</ul><p>x")) == "<ul>(<li>#TEXT</li>)+</ul><p>#TEXT</p>"
    assert html_wrapper.pattern(items("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><h2>e</h2><p>f")) == "(<h2>#TEXT</h2><p>#TEXT</p>)+"
    joined = html_wrapper.align(items("<div>a</div><p>x</p><pre>y</pre>"), items("<div>a</div><pre>y</pre>"))
    assert html_wrapper.pattern(joined) == "<div>#TEXT</div>(<p>#TEXT</p>)?<pre>#TEXT</pre>"
    many = items("".join(f"<div class='{chr(97 + i % 26)}{chr(97 + i // 26)}'><p>{i}</p></div>" for i in range(600)))
    assert len(many) <= html_wrapper.WIDEST and sum(s.n for s in html_wrapper.slots(many)) == 600


def test_wrappers(spark):
    rows = [("http://a/", "<body><h1>t</h1><p>x</p>"), ("http://a/", "<body><h1>t</h1><p>x</p><p>y</p><ul><li>l</ul>"), ("http://b/", "<body>z")]
    df = spark.createDataFrame([(i, u, h, "x", 1, "l") for i, (u, h) in enumerate(rows)], SCHEMA)
    got = {r["host"]: (r["n_streams"], r["wrapper"]) for r in html_extract.wrappers(df).collect()}
    assert got == {"a": (2, "<body><h1>#TEXT</h1>(<p>#TEXT</p>)+(<ul><li>#TEXT</li></ul>)?</body>"), "b": (1, "<body>#TEXT</body>")}
