"""Content regions: the scan against all runs, hand-made pages of several layouts, the smoke table's articles."""

import html
import random
import re

from citypulse.llm import html_extract, queries
from citypulse.llm.common import table
from conftest import SMOKE

W = html_extract.DEFAULTS
PARA = "This is a sentence of the article that goes on for a while so that it counts."


def test_best_run_is_the_best_of_all_runs():
    rng = random.Random(8)
    for _ in range(300):
        s = [rng.randint(-4, 4) for _ in range(rng.randrange(0, 12))]
        lo, hi = html_extract.best_run(s)
        assert sum(s[lo:hi]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1))])


def test_layouts():
    noise = ('<header><a href="/">Site name of ours</a></header><nav><ul><li><a href="/x">Menu one</a><li><a href="/y">Menu two'
             '</a></ul></nav><div class="cookie-notice">We use cookies on this site, please agree to all of them.</div>')
    tail = ('<section id="comments"><h2>Comments</h2><p>I like this article a lot, said a reader here.</p></section>'
            '<aside class="sidebar"><p>Read other things too, there are many of them.</p></aside><form><p>Sign up'
            '</p><input name=q></form><footer>&copy; 2020 us <a href="/imprint">Imprint</a></footer>')
    want = f"Title & more\n{PARA}\nx < y, é — {PARA}\none of the things\ntwo of the things"
    body = (f"<h1>Title &amp; more</h1><p>{PARA}<p>x &lt; y,\n &eacute; &#8212;  <b>{PARA[:4]}</b>{PARA[4:]}</p>"
            "<script>if (a < b) { '<p>no</p>' }</script><ul><li>one of the things</li><li>two of the things</li></ul><!-- <p>hidden</p> -->")
    ad = '<div class="ad-box"><p>Buy this now, it is very cheap and good for you.</p></div>'
    for page in (f"<html><head><title>T</title><style>p{{}}</style></head><body>{noise}<article>{body}</article>{tail}</body></html>",
                 f"<body>{noise}<main><div>{body}{tail}</div></main>", f"{noise}<article>{body}", f"{noise}<div id=content>{body}</div>{tail}",
                 f"<BODY>{noise}<ARTICLE CLASS='post'>{body.replace('<ul>', ad + '<ul>')}</ARTICLE>{tail}"):
        assert html_extract.main_text(page, W) == want, page
    own = (f'<div class="has-sidebar"><article class="post comments-open">{body}</article></div><ol class="commentlist">'
           '<article class="comment"><p>First comment of a reader of this.</p></article></ol><div id="cookiebar"><p>We use '
           'cookies here, do you agree?</p></div>')
    assert html_extract.main_text(own, W) == want


def test_broken_and_empty_pages(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    pages = [None, "", "<html></html>", "just words", "<p>cut off at <a href='x", "<div class=\"ad\">only an advert</div>",
             f"<article><p>{long}</p></article>", "a < b and c > d", "<article><p>in</p><form><p>open form<article><p>more</p>",
             "<p>&nbsp; &#0; &bogus; &amp</p>", "<" * 5000, "<p title=\"" + "a'" * 5000]
    df = spark.createDataFrame([(i, None, p, "clash") for i, p in enumerate([*pages, pages[3]])],
                               "page_id long, url string, html string, text string")
    rows = {r["page_id"]: r for r in html_extract.extract(df).collect()}
    assert len(rows) == len(pages) + 1
    assert all(rows[i]["text"] == "" for i in (0, 1, 2, 5))
    assert rows[3]["text"] == rows[len(pages)]["text"] == "just words" and rows[6]["text"] == long
    assert rows[7]["text"] == "a < b and c > d" and rows[9]["text"] == "� &bogus; &"
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert html_extract.extract(df.limit(0)).collect() == []


def test_smoke_pages_give_their_articles(spark):
    pages = table(spark, SMOKE, "pages").collect()
    got = {r["page_id"]: r for r in queries.QUERIES["op1_html_extract"](spark, SMOKE).collect()}
    assert got.keys() == {p["page_id"] for p in pages}
    for p in pages:
        inner = re.search(r"<article>(.*?)(</article>|$)", p["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br|ul|li|div)\b[^>]*>", inner)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert got[p["page_id"]]["text"] == "\n".join(b for b in want if b), p["page_id"]


def test_noise_names_never_empty_a_page():
    """An element around the whole article keeps its text whatever its names; noise inside and beside it still goes."""
    article = "<h1>Head line</h1><p>Many words of the first block here.</p><p>Many words of the second block.</p>"
    side = "<div class='sidebar'><a href='x'>one</a> <a href='y'>two</a></div><form><p>sign up</p></form>"
    for name in ("content ad-free", "market-share", "search-history", "notice", "related-work"):
        page = f"<html><body>{side}<div class='{name}'>{article}<div class='share-bar'>share me</div></div>{side}</body></html>"
        got = html_extract.main_text(page, html_extract.DEFAULTS)
        assert got == "Head line\nMany words of the first block here.\nMany words of the second block.", name
    assert html_extract.main_text("<div class='ad'></div>", html_extract.DEFAULTS) == ""
    assert html_extract.main_text("<nav>menu words</nav>", html_extract.DEFAULTS) == ""
