"""Main text of pages: structure, odd markup, the scan, the given table."""

import html as html_lib
import random
import re

import pytest

from croptide.llm import pages
from croptide.llm.queries import op10_html

PAGES = "page_id long, url string, html string"
SF = "/root/testdata/sf0.001"
W = {"word": 1.0, "boiler": -1.0, "tag": -2.0, "<p>": -0.1, "<h1>": -0.1, "<div>": -1.0}


def text(page):
    return pages.main_text(page, W)


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
    <script>var a = "</p><article>x</article>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies on this site to make it better for everyone</div>
    <div class="ad">Buy this thing now and save a lot of money today only</div>
    <main><article><h1>Head &amp; line</h1><p>One <b>two</b>thr<i>ee</i>.<br>Four
      five&nbsp;six<p class="ad">Ad<p>Seven &lt;b&gt; &#233;<ul><li>eight<li>nine</ul>
      <aside>Side</aside><form><input>Send<button>OK</button></form><!-- no > comment -->
      <div hidden>no</div><div style="display: none">no</div><noscript>no</noscript></article>
    <section id="comments"><article class="comment"><p>First! I think this is a great and long
      article to comment on, is it not</article></section></main>
    <aside class="sidebar">Related things to read, with many more words than you expect</aside>
    <footer>&copy; me</footer></body></html>"""
    assert text(page) == ("Head & line\n\nOne twothree. Four five six\n\nSeven <b> é\n\n"
                          "eight\n\nnine")


def test_page_without_article_element():
    body = "<p>" + "many words of a story " * 20 + "</p><p>" + "and more of it " * 20 + "</p>"
    page = ("<body><div><a href=1>x</a><a href=2>y</a></div><div id=content>" + body
            + "</div><div><span>a</span><span>b</span><span>c</span></div></body>")
    assert text(page) == ("many words of a story " * 20).strip() + "\n\n" + (
        "and more of it " * 20).strip()


@pytest.mark.parametrize("page, want", [
    ("", ""), ("just text & more", "just text & more"), ("a < b and 3 > 2", "a < b and 3 > 2"),
    ("<p>x", "x"), ("<article></article>", ""), ("<!-- open", ""), ("<script>var x", ""),
    ("<article><p>&notit; &#x41;&amp;lt;</article>", html_lib.unescape("&notit;") + " A&lt;"),
    ("</p></div>x", "x"), ("<article><p>a</b></i>b</article>", "ab"),
])
def test_odd_markup(page, want):
    assert text(page) == want


def test_best_run_is_the_largest_sum():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.choice([-2, -1, 0, 1, 2]) for _ in range(rng.randrange(0, 12))]
        lo, hi = pages.best_run(s)
        most = max([0, *(sum(s[a:b]) for a in range(len(s)) for b in range(a, len(s) + 1))])
        assert sum(s[lo:hi]) == most


def test_long_and_deep_pages():
    assert text("<article><p>" + "w " * 300_000 + "</article>").count("w") == 300_000
    assert text("<div>" * 3000 + "x y z" + "</div>" * 3000 + "</span>" * 3000) in ("x y z", "")


def test_given_pages(spark):
    """Against the article's markup, which the given pages have in one simple form."""
    rows = {r["page_id"]: r for r in op10_html(spark, SF).collect()}
    given = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) == len(given)
    for r in given:
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ")
        blocks = (re.sub("<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)[^>]*>", body))
        want = "\n\n".join(b for b in (" ".join(html_lib.unescape(x).split()) for x in blocks) if b)
        assert rows[r["page_id"]]["text"] == want
        assert rows[r["page_id"]]["n_chars"] == len(want)


def test_learned_weights_and_odd_rows(spark):
    good = "<nav><a>x</a></nav><article><h1>T</h1><p>a b c d e f</p></article>"
    frame = spark.createDataFrame([(1, "u", good, 5), (None, None, None, 5), (1, "u", good, 5)],
                                  PAGES + ", n_chars int")
    weights = pages.learn_weights(frame)
    assert weights["word"] > 0 > weights["<p>"]
    assert all(w < 0 for k, w in weights.items() if k != "word")
    out = pages.extract(frame)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or -1, r["text"]) for r in out.collect()) == [
        (-1, ""), (1, "T\n\na b c d e f"), (1, "T\n\na b c d e f")]
    none = spark.createDataFrame([], PAGES)
    assert pages.learn_weights(none) == pages.DEFAULTS
    assert pages.extract(none).count() == 0
