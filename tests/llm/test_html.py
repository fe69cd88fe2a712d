import re
from html import unescape

import pytest

from keepwell.llm import html as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><ul><li><a href="/a">Menu one</a><li><a href='/b'>Menu two</a></ul></nav></header>
<div id="cookie-notice"><p>We use cookies on this site, please agree to them all.</p></div>
<div class="wrap-12"><div class="post-content"><h2>Title &amp; more</h2>
<p>First   para with <b>bo</b>ld and <a href="x>y">a link</a>.<p>Second &lt;para&gt; that is not&nbsp;closed and goes on.
<div class="ad-slot"><p>Buy now!</p></div><form><p>Sign up here</p><input><button>Go</button></form>
<ul><li>one<li>two</ul><blockquote>Quote</blockquote><table><tr><td>a<td>b<tr><td>c</table>
<script>var x = "<p>not this</p>";</script><!-- <p>nor this</p> --><br>end</div>
<div class="comments"><p>{comment}</p></div></div>
<aside><p>Related stories for you</p></aside><footer>Imprint</footer></body></html>"""
TEXT = "Title & more First para with bold and a link. Second <para> that is not closed and goes on. one two Quote a b c end"


def test_article_without_what_surrounds_it():
    text, path = H.chosen(PAGE.replace("{comment}", "Nice. " * 300), {})
    assert text == TEXT
    assert path == "/html/body.has-sidebar/div.wrap-#/div.post-content"


def test_generated_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    want = {}
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        article = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)>", " ", article))
        want[r.page_id] = re.sub(r"\s+", " ", unescape(article)).strip()
    found = H.main_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    assert {r.page_id: r.text for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found)


def page(article, comments="", tag="div"):
    return f"<html><body><{tag} class='story-{len(article)}'>{article}</{tag}><div class='talk'>{comments}</div></body></html>"


def test_hosts_agree_on_a_path(spark):
    long, short = "<p>" + "A long sentence of the story. " * 30 + "</p>", "<p>" + "Short story. " * 20 + "</p>"
    talk = "<p>" + "Much talk about it. " * 20 + "</p>"
    rows = [(i, "http://h.example/x", page(long.replace("A", "AB"[i % 2]))) for i in range(9)]
    # alone, this page's talk would win; its host knows better
    rows += [(50, "https://H.example:80/y?z", page(short, talk)), (51, "//other.example/", page(short, talk))]
    rows += [(60, "http://h.example", page(long, tag="section")), (61, None, page(long)), (62, "no host", "")]
    rows += [(63, "http://h.example", None), (63, "http://h.example", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in H.main_text(pages).collect()}
    assert found[50].text.startswith("Short story") and found[51].text.startswith("Much talk")
    assert found[50].host == "h.example" and found[51].host == "other.example"
    assert found[60].text.startswith("A long") and "section" in found[60].path  # of another make
    assert found[61].host == "" and found[61].text and found[62].text == found[63].text == ""
    assert H.main_text(pages).count() == len(rows)


def test_votes_and_choices_equal_a_plain_loop(spark):
    """Votes added up by hand, page by page, and each page's choice among them."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.select("page_id", H.host("url").alias("host"), "html").collect()
    votes = {}
    for r in rows:
        page = H.read(r.html)
        for path, share in H.best_paths(page):
            mine = votes.setdefault(r.host, {})
            key = H.path_key(page.spelled(page.widened(path)))
            mine[key] = mine.get(key, 0) + round(share * 1e6)
    got = {}
    for r in H.ballots(pages).collect():
        got.setdefault(r.host, {})[bytes(r.path)] = r.votes
    assert got == votes
    want = {r.page_id: H.chosen(r.html, votes[r.host]) for r in rows}
    assert {r.page_id: (r.text, r.path) for r in H.main_text(pages).collect()} == want


def test_join_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(H, "MOST_HOSTS", 0)
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert H.main_text(pages).where("text = ''").count() == 0


def test_empty_table_and_extra_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", page("<p>x y z</p>"), "t", 1)], "page_id long, url string, html string, text string, host int")
    (row,) = H.main_text(pages).collect()
    assert row.text == "x y z"
    assert H.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "source, text",
    [
        ("plain text only", "plain text only"),
        ("<p>a<p>b", "a b"),
        ("<b>a</b>b &lt;tag&gt; c &#233;&eacute;", "ab <tag> c éé"),
        ("x &amp;lt; y", "x &lt; y"),
        ("a<br>b<br/>c", "a b c"),
        ("<![CDATA[x < y]]> z", "x < y z"),
        ("1 < 2 and <unclosed", "1 < 2 and <unclosed"),
        ("<pre>a\n  b</pre>", "a b"),
        ("<textarea>no</textarea><svg><text>no</text></svg><noscript>no</noscript>yes", "yes"),
        ("<p>a</b></i></p></div>b", "a b"),
        ("<div hidden>no</div><div role=navigation>no</div>yes", "yes"),
        ("<p>" * 3000 + "deep", "deep"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<" * 3000, "<" * 3000),
        ("<div class='page-content has-sidebar'>yes</div><div class='has-sidebar-right'>yes</div>", "yes yes"),
        ("<div class='cookieBar'>no</div><div class=commentform>no</div><div id=commentary>yes</div>", "yes"),
        ("<div class='entry-footer'>no</div><p class='main-nav'>no</p><div class='address'>yes</div>", "yes"),
        ("<form id=f><div><p>all in a form</p><script>no</script></div></form>", "all in a form"),
        ("<p>text</p><form>no</form>", "text"),
    ],
)
def test_markup(source, text):
    assert H.chosen(source, {})[0] == text


@pytest.mark.parametrize("most", [200_000, 0])
def test_all_templates_of_a_host_have_their_votes(spark, monkeypatch, most):
    monkeypatch.setattr(H, "MOST_HOSTS", most)
    story, talk = "<p>" + "A story. " * 40 + "</p>", "<p>" + "Much talk. " * 60 + "</p>"
    make = lambda c, talk="": f"<html><body><div class='{c}'>{story}</div><div class='chat'>{talk}</div></body></html>"
    names = [f"make-{a}" for a in "abcdefghijklmnopqrstuvwxyz"]
    more = [(90, "http://g/", make(c)) for c in names for _ in range(3)] + [(91, "http://g/", make(names[-1], talk))]
    found = H.main_text(spark.createDataFrame(more, "page_id long, url string, html string")).collect()
    (last,) = [r for r in found if r.page_id == 91]
    assert last.path == "/html/body/div.make-z" and last.text.startswith("A story")


LONG = "Some more words of this long text. " * 30


@pytest.mark.parametrize(
    "article",
    [
        f"<article><h1>Head</h1><p>Lead.</p><section><p>{LONG}</p></section><section><p>{LONG}</p></section></article>",
        f"<div class=post><h2>Head</h2><p>Lead.</p><section><p>{LONG}</p></section><section><p>{LONG}</p></section></div>",
        f"<div class=post><h1>Head</h1><p>Lead.</p><ul><li>{LONG}<li>{LONG}</ul><p>End.</p></div>",
        f"<article><p>Lead.</p><table><tr><td>{LONG}<td>{LONG}<tr><td>{LONG}</table><p>End.</p></article>",
        f"<article><div class=a><div class=b><p>{LONG}</p></div></div><p>End.</p></article>",
    ],
)
def test_an_article_keeps_what_stands_beside_its_largest_part(article):
    want = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", article)).strip()
    talk = "<div class='talk'><p>Some talk about it.</p></div>"
    assert H.chosen(f"<html><body>{article}{talk}</body></html>", {})[0] == want


def test_a_hosts_path_does_not_cut_an_article():
    source = f"<html><body><article><div class=a><p>{LONG}</p></div><div class=b><p>{LONG * 2}</p></div></article></body></html>"
    assert H.chosen(source, {H.path_key("/html/body/article/div.a"): 1})[0] == (LONG * 3).strip()


@pytest.mark.parametrize("depth", [40, 57, 80, 3000])
def test_depth_does_not_matter(depth):
    article = f"<div class=text><p>{LONG}</p><p>{LONG}</p></div><div class=talk><p>Another part that is shorter than that.</p></div>"
    got, path = H.chosen("<html><body>" + "<div>" * depth + article + "</div>" * depth + "</body></html>", {})
    assert got == (LONG * 2).strip() and path.count("/") == depth + 3


def test_long_attributes():
    alt = "a > b " * 5000
    assert H.chosen(f'<html><body><article><p>{LONG}<img alt="{alt}" src=x>{LONG}</p></article></body></html>', {})[0] == (LONG + LONG).strip()
    assert H.chosen(f"<p title='{alt}'>{LONG}</p><p>1 < 2 \"quoted\" 'text</p>", {})[0] == LONG.strip() + " 1 < 2 \"quoted\" 'text"


@pytest.mark.parametrize(
    "name", "share-price-report tags-article related-work search-results-analysis comment-piece notice-of-motion skip-logic comments ad".split()
)
def test_a_name_does_not_empty_a_page(name):
    assert H.chosen(f"<html><body><div class='{name}'><p>{LONG}</p></div></body></html>", {})[0] == LONG.strip()


def test_names_of_other_parts_leave_them_out():
    rest = "comment-list related-posts ad-slot-3 sidebar-left newsletter-signup-form main-nav cookieNotice site-footer share-buttons".split()
    parts = "".join(f"<div class='{c}'><p>{LONG} no</p></div>" for c in rest)
    assert H.chosen(f"<html><body>{parts}<div class=post><p>{LONG}</p></div>{parts}</body></html>", {})[0] == LONG.strip()
