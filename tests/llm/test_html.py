import html as entities
import re
from collections import Counter

import pytest

from storelens.llm import html

from .conftest import SF_DIR, clash, rows_of

PROSE = ("The house that stands at the end of the road is one of the oldest in the town, and it has been "
         "in the hands of the same family for more than two hundred years, as far as anyone can tell.")


def test_articles_of_the_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    page = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html.extract(pages).collect():
        article = re.search(r"<article>(.*)</article>", page[r["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", article))
        want = " ".join(filter(None, (re.sub(r"\s+", " ", entities.unescape(p)).strip() for p in parts)))
        assert r["text"] == want and r["n_chars"] == len(want)


def test_what_is_not_the_article_goes():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body class="single">
    <header><h1>Site</h1></header><nav><a href="/">Home</a></nav><div class="cookie-notice">{PROSE}</div>
    <div id="sidebar">{PROSE}</div><aside>{PROSE}</aside><form><p>{PROSE}</p><button>Go</button></form>
    <article><header><h1>The house</h1></header><p>{PROSE}<br>Short&nbsp;one &amp; more<p>Unclosed
      <b>bold</b>&#33;</p><script>if (a < b) "</p>"</script><!-- {PROSE} --><div class="ad">{PROSE}</div>
      <ul><li>first<li>second</ul><noscript>{PROSE}</noscript>
      <section class="comments"><p>{PROSE}</p></section></article>
    <footer>© {PROSE}</footer></body></html>"""
    assert html.main_text(page) == f"The house {PROSE} Short one & more Unclosed bold! first second"


def test_pages_without_article_go_by_density():
    page = f"""<div class=menu><a href=a>One</a> <a href=b>Two</a></div><h2>The house</h2><div>{PROSE}</div><p>Indeed.</p>
    <p>{PROSE}</p><p><a href=c>Read</a> <a href=d>more</a></p><p>© 2020 Someone</p><td>Buy cheap pills online best
    price fast shipping discount offer today only limited stock</td>"""
    assert html.main_text(page) == f"The house {PROSE} Indeed. {PROSE}"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<", ""), ("<p", ""), ("plain", ""), ("<article>a", "a"), ("<article>a <b c='>'>d", "a d"),
    ("<article>a<script>b", "a"), ("<article>x &lt;p&gt; y</article>", "x <p> y"), ("<article></article>", ""),
    ("<main>z</main></div></p>", "z"), ("<article><p>a</div>b</p></article>", "a b"),
    ("<article>&am &amp &notanentity;</article>", "&am & ¬anentity;"),
])
def test_odd_pages(page, text):
    assert html.main_text(page) == text


def test_long_pages_take_linear_time():
    page = "<div>" * 30_000 + "<article>" + "<p>word " * 30_000 + "</article>"
    assert html.main_text(page) == " ".join(["word"] * 30_000)
    assert html.main_text("<p>short</p>" * 20_000) == ""


def test_table_edges(spark):
    rows = [(1, "u", "<article>a</article>"), (1, "u", "<article>a</article>"), (None, None, None), (2, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = [(None, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0)]
    assert rows_of(html.extract(clash(df).withColumn("n_chars", df.html))) == want
    assert html.extract(df.limit(0)).count() == 0


STORY = ("The council has met in the old town hall and it was agreed that the bridge will be built by the end of the "
         "year, so that all of the people on the other side of the river can get to their work on time.")


@pytest.mark.parametrize("before, after", [
    ('<div class="overflow-hidden"><p>', "</p></div>"),
    ('<div data-state="not hidden"><article><p>', "</p></article></div>"),
    ('<div class="site has-sidebar"><article><p>', "</p></article></div>"),
    ('<div class="post tag-news"><p>', "</p></div>"),
    ('<div class="widget page"><main><p>', "</p></main><div class=\"comments\"><article><p>I do not like it at all, "
     "and that is what I have to say about it.</p></article></div></div>"),
    ('<div id="social"><p>', "</p></div><p>Short</p>"),
])
def test_layout_classes_keep_the_article(before, after):
    page = f'<html><body><div class="ad"><p>Buy it now and be happy with it.</p></div>{before}{STORY}{after}</body></html>'
    assert html.main_text(page).startswith(STORY) and "Buy" not in html.main_text(page)
    assert "like it" not in html.main_text(page)


def test_hidden_elements_are_silent():
    for attribute in ("hidden", 'hidden=""', 'aria-hidden="true"', 'style="color:red;display: none"'):
        assert html.main_text(f"<body><p>{STORY}</p><div {attribute}><p>{STORY} Unseen.</p></div></body>") == STORY


def test_long_comments_are_not_the_article():
    """However much readers write, in pages with and without a mark."""
    talk = "".join(f"<p>{STORY} That is what I think of it.</p>" for _ in range(9))
    for kind in ('div class="comments"', 'section id="disqus"', 'article class="comment"'):
        name = kind.split()[0]
        assert html.main_text(f"<body><p>{STORY}</p><{kind}>{talk}</{name}></body>") == STORY
        assert html.main_text(f"<body><main><p>{STORY}</p><{kind}>{talk}</{name}></main></body>") == STORY


def test_paragraphs_of_links_inside_the_article_stay():
    link = '<a href="x">the whole story of the bridge and of the people who have built it</a>'
    page = f"<article><p>{STORY}</p><p>Read {link}.</p><ul><li><a href=a>One more story of the bridge</a><li><a href=b>And one of the river</a></ul></article>"
    text = re.sub("<.*?>", "", link)
    assert html.main_text(page) == f"{STORY} Read {text}."


def test_signs_and_cells_between_text_stay():
    page = f"<body><p>{STORY}</p><p>© is the sign of a right.</p><table><tr><td>Bridge 1904 iron 120 metres long, 9 metres wide, 3 arches</td></tr></table><p>{STORY}</p></body>"
    assert html.main_text(page) == f"{STORY} © is the sign of a right. Bridge 1904 iron 120 metres long, 9 metres wide, 3 arches {STORY}"


def test_pages_without_their_mark(spark):
    """The two passes alone, on the pages of the table without the tag of their article, against the same
    articles: the share of words that are found, and of those that belong there."""
    found = kept = right = 0
    for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("html").collect():
        want = html.main_text(row.html).split()
        got = html.main_text(re.sub("</?article>", "", row.html)).split()
        both = sum((Counter(want) & Counter(got)).values())
        found, kept, right = found + len(want), kept + len(got), right + both
    print("share found", right / found, "share right", right / kept)
    assert right / found >= 0.9 and right / kept >= 0.9
