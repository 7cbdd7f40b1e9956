"""Main text of hand-made pages and sites."""

import html
import re

import pytest

from hazlake.llm import sitetree

SCHEMA = "page_id long, url string, html string"
NONE = frozenset()


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain  words\n here", "plain words here"),
        ("<p>one<p>two <b>th</b>ree<br>four", "one two three four"),
        ("<article><h1>T&eacute;&#x6c;&#0000039;&amp;lt;</h1><p>a&nbsp;b</p></article>", "Tél'&lt; a b"),
        ("<nav>menu</nav><article><p>x</p></article><footer>f</footer>", "x"),
        ("<header>h</header><main><header><h1>Title</h1></header><p>x</p></main>", "Title x"),
        ("<article><p>x</p><aside>a</aside><div class='share-bar'>s</div><form>f<input value=q>g</form><p>y</p></article>", "x y"),
        ("<div class='layout has-sidebar'><article>in</article><div class=sidebar>out</div></div>", "in"),
        ("<article>in</article><section class='comments'><article class='comment'>bad</article></section><div>other</div>", "in"),
        ("<div class='cookie-notice'>c</div><div><p>no article here</p></div>", "no article here"),
        ("<article>a<script>x='</p>'</script>b<style>p{}</style><!-- <p>no</p> -->c</article>", "abc"),
        ("<article>a<script>never closed <p>b</p></article>", "a"),
        ("<article><a title='1 > 2'>link</a> <img alt=\"<p>\"> 3 < 4</article>", "link 3 < 4"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a b c d e"),
        ("<article><p hidden>h</p><div style='display: none'>n</div>x</article>", "x"),
        ("<ARTICLE><P>upper</P></ARTICLE><NAV>no</NAV>", "upper"),
        ("</div></p><article>stray</article></html>", "stray"),
    ],
)
def test_main_text(page, text):
    assert sitetree.main_text(page, NONE) == text


def site(n, host="a.example"):
    pages = []
    for i in range(n):
        body = f"<p>story {i} begins</p><p>and goes on {i * i}</p><p>a line that all share</p>"
        box = "<div class='x9'><p>Buy our thing today</p></div>"
        foot = f"<div class='y{i}'>Made by {i % 2}</div>"
        pages.append((i, f"https://{host}/p{i}", f"<html><body><div id='c'><div class='t'>{body}{box}</div></div>{foot}</body></html>"))
    return pages


def test_branches_of_low_importance_go(spark):
    rows = site(30)
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    for i in range(30):
        # The repeated box and the footer go; the paragraphs' branch stays whole, its repeated line included.
        assert got[i] == f"story {i} begins and goes on {i * i} a line that all share"


def test_a_few_pages_or_copies_are_left_alone(spark):
    few = [(100 + i, f"https://b.example/{i}", "<article><p>one text</p></article>") for i in range(5)]
    copies = [(200 + i, f"https://c.example/{i}", "<article><h1>t</h1><p>one text</p></article>") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(few + copies, SCHEMA)).collect()}
    assert {got[100 + i] for i in range(5)} == {"one text"} and {got[200 + i] for i in range(20)} == {"t one text"}


def test_importance_follows_the_definition(spark):
    import math

    nodes = {r["path"]: r for r in sitetree.style_tree(spark.createDataFrame(site(16), SCHEMA)).collect()}
    box = nodes["html/body/div.c/div.t/div.x0/p"]
    assert (box["pages"], box["texts"]) == (16, 1) and box["text_entropy"] == pytest.approx(1.0)
    story = nodes["html/body/div.c/div.t/p"]
    assert story["texts"] == 33 and story["text_entropy"] == pytest.approx(1.0)
    foot = nodes["html/body/div.y0"]
    assert foot["text_entropy"] == pytest.approx(2 * math.log(8) / math.log(16))


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "no url", "<p>x</p>"), (2, "http://", ""), (3, "HTTPS://u:p@A.Example:80/x", "<p>y</p>")] * 2
    pages = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in sitetree.extract(pages.selectExpr("*", "1 AS host", "'r' AS removed")).collect()), key=repr)
    assert got == sorted([(1, "", 0), (None, "x", 1), (2, "", 0), (3, "y", 1)] * 2, key=repr)
    assert sorted({r[0] for r in pages.select(sitetree.host_of(pages["url"])).collect()}) == ["", "a.example"]
    assert sitetree.extract(pages.limit(0)).count() == 0


def test_long_page():
    page = "<article>" + "<p>word &amp; more" * 50_000 + "<div class='" * 200 + "</article>"
    assert sitetree.main_text(page, NONE).startswith("word & more word & more")


def test_given_pages_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in sitetree.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " \n ", inner)))
        assert got[r["page_id"]] == " ".join(want.split())


def nameless(page):
    """The page without a name that tells what a branch is for: what is left is the tree."""
    for name, plain in (("<footer>", "<div class=f>"), ("<nav>", "<div class=n>"), ("nav>", "div>"), ("footer>", "div>"), ("article>", "section>"), ('class="ad"', 'class="k"')):
        page = page.replace(name, plain)
    return page


def article_of(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " \n ", inner))).split())


def test_the_tree_alone_finds_the_article(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    pages = spark.createDataFrame([(r["page_id"], r["url"], nameless(r["html"])) for r in given], SCHEMA)
    got = {r["page_id"]: r["text"] for r in sitetree.extract(pages).collect()}
    right = sum(got[r["page_id"]] == article_of(r["html"]) for r in given)
    bare = sum(sitetree.main_text(nameless(r["html"]), NONE) == article_of(r["html"]) for r in given[:200])
    assert right >= 0.9 * len(given) and bare == 0


def other_pages(n):
    """Pages of a second kind: no content root, one short text where the others have their menu's neighbour."""
    return [(900 + i, "https://d.example/faq", f"<html><body><div class=q><p>answer {i} in short</p></div></body></html>") for i in range(n)]


def test_branches_beside_the_root(spark):
    def page(i):
        story = "".join(f"<p>{' '.join(f'w{i}x{k}y{j}' for j in range(40))}</p>" for k in range(3))
        links = "".join(f"<li><a href=/{k}>go {i} to {k}</a></li>" for k in range(5))
        lead = f"<div class=l>{' '.join(f'lead{i}x{j}' for j in range(25))}</div>"
        return (
            f"<html><body><h1>title {i}</h1><ul class=u>{links}</ul>{lead}<div class=q><p>buy {i} now</p></div>"
            f"<div class=s>{story}<ul>{links}</ul><h2>part {i}</h2></div><div class=z>made {i} by us</div></body></html>"
        )

    rows = [(i, "https://d.example/x", page(i)) for i in range(12)] + other_pages(6)
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    for i in range(12):
        assert f"title {i}" in got[i] and f"lead{i}x24" in got[i] and f"w{i}x2y39" in got[i] and f"part {i}" in got[i]
        assert "buy" not in got[i] and "made" not in got[i]
        # Links beside the root go, those inside stay.
        assert got[i].count(f"go {i} to 0") == 1
    assert all(got[900 + i] == f"answer {i} in short" for i in range(6))


@pytest.mark.parametrize("name", "user-comments reader-comments responses discussion user-feedback related-articles top-bar cookiebar global-nav SideBar adsbygoogle taboola promo-card".split())
def test_marked_classes(name):
    assert sitetree.main_text(f"<article><p>two words</p></article><div class='{name}'><p>{BODY}</p></div>", NONE) == "two words"
    assert sitetree.main_text(f"<div><p>two words</p></div><div id='{name}'><p>{BODY}</p></div>", NONE) == "two words"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<nav><a href=/>menu</a> entry</nav>", ""),
        ("<ul class=menu><li><a href=/>one</a><li><a href=/>two</a></ul>", ""),
        ("<form id=aspnet><nav>menu</nav><div><p>the whole page</p></div></form>", "the whole page"),
        ("<h1>Title</h1><article><p>in it</p></article>", "Title in it"),
        ("<div id=comments><p>only readers</p></div>", ""),
    ],
)
def test_pages_of_one_kind_of_thing(page, text):
    assert sitetree.main_text(page, NONE) == text


def test_paragraphs_beside_an_article_stay():
    out = " ".join(f"out{i}" for i in range(50))
    assert sitetree.main_text(f"<article><p>{BODY}</p></article><div><p>{out}</p></div>", NONE) == f"{BODY} {out}"


BODY = " ".join(f"own{i}" for i in range(60))


@pytest.mark.parametrize(
    "page, there, gone",
    [
        (f"<div id=content><p>{BODY}</p></div>" + "<article><h2>teaser</h2><p>of another page</p></article>" * 6, BODY, None),
        (f"<div id=content><p>{BODY}</p></div><div class=related><article>teaser one</article><article>teaser two</article></div>", BODY, "teaser"),
        (f"<div class=sidebar><main>teaser</main></div><div><p>{BODY}</p></div>", BODY, "teaser"),
        (f"<article class='post comments-open'><p>{BODY}</p></article>", BODY, None),
        (f"<div class='entry has-comments'><p>{BODY}</p></div><div id=comments>reply text</div>", BODY, "reply"),
        (f"<div class='content with-sidebar'><p>{BODY}</p><div class=sidebar>beside</div></div>", BODY, "beside"),
        (f"<div class='page has-ads'><p>{BODY}</p><div class='ad-slot'>buy</div></div>", BODY, "buy"),
        (f"<h1>t</h1><div class=sidebar><p>{BODY}</p></div>", BODY, None),
        (f"<div id=comments><p>{BODY}</p></div><article><p>{' '.join(['word'] * 20)}</p></article>", "word", "own1"),
    ],
)
def test_marks_do_not_take_the_text_away(page, there, gone):
    text = sitetree.main_text(page, NONE)
    assert there in text and (gone is None or gone not in text)
