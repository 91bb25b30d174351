import random
import time

import __spark_entry__ as contract
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import html

SCHEMA = "page_id long, url string, html string"


def text(page, deleted=()):
    return html.main_text(page, list(deleted))


def test_query(spark, table):
    got = {r.page_id: r for r in contract.queries()["op3_main_text"](spark, SF).collect()}
    pages = table("pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = p.html.partition("<article>")[2].partition("</article>")[0]
        blocks = article.replace("<b>", "").replace("<br>", " ").replace("</p>", "<p>").replace("<h1>", "<p>").replace("</h1>", "<p>").split("<p>")
        assert got[p.page_id].text == "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


@pytest.mark.parametrize("page,want", [
    ("", ""),
    ("plain &amp; simple  text", "plain & simple text"),
    ("<nav>menu</nav><article><h1>T</h1><p>a <b>b</b>\n c<p>d</article><footer>f</footer>", "T\na b c\nd"),
    ("<header>h</header><main><header>Title</header><p>x</p><aside>s</aside><form>q<input></form></main>", "Title\nx"),
    ("<article><p>one</p><section class='comments'><article><p>reader</p></article></section><p>two</p></article>", "one\ntwo"),
    ("<article><div class='ad'>buy</div><div id=cookie-notice>ok?</div><p class=\"lead shadow\">in</p></article>", "in"),
    ("<script>var a='</p><article>no</article>';</script><style>p{}</style><article>yes<!-- <p>no --></article>", "yes"),
    ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>e</article>after", "a\nb\nc\nd\ne"),
    ("<article><p title=\"a > b\">x &lt;y&gt; &eacute;&#233;&#xe9;</p><p>1 < 2", "x <y> ééé\n1 < 2"),
    ("<article><p hidden>h</p><p style='display: none'>n</p><p>v</p></article>", "v"),
    ("<div role=navigation>m</div><div role='main'><p>x</div><div>rest</div>", "x"),
    ("<p>a</p><p class=\"unclosed>b</p><p>c</p>", "a\nb\nc"),
    ("<article><p>a<script>", "a"),
    ("<ARTICLE><P>A</P></ARTICLE>", "A"),
])
def test_structure(page, want):
    assert text(page) == want


def test_shared_lines_go_where_no_content_is_marked(spark, clash):
    page = lambda i: f"<div>Site of Bob</div><div>Home</div><h1>Title {i}</h1><p>Story {i} one.</p><p>Story {i} two.</p><p>Words {i}.</p><div>Imprint</div>"
    rows = [(i, f"http://Host{i % 2}.org/dir{i % 3}/p{i}?q", page(i)) for i in range(12)]
    rows += [(50, "http://alone.org/x", page(50)), (51, None, None), (52, "http://host0.org/dir0/p0?copy", page(0)), (53, "no url", "<p>x</p>"), (0, rows[0][1], rows[0][2])]
    rows += [(60 + i, f"http://host3.org/{i}", f"<div>Top</div><article><div>Home</div>Mine {i}</article>") for i in range(2)]
    got = html.extract(clash(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    for i in range(1, 12):
        assert by[i] == f"Title {i}\nStory {i} one.\nStory {i} two.\nWords {i}."
    assert by[50] == "Site of Bob\nHome\nTitle 50\nStory 50 one.\nStory 50 two.\nWords 50.\nImprint"
    assert by[51] == "" and by[53] == "x" and by[60] == "Home\nMine 0"


def test_blocks_have_the_neighbours_of_their_ends(spark, monkeypatch):
    rows = [(i, f"http://h/{i:03d}", f"<div>Same</div><p>own {i}</p><p>more {i}</p>") for i in range(40)]
    monkeypatch.setattr(html, "BLOCK", 3)
    assert {r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()} == {f"own {i}\nmore {i}" for i in range(40)}


SITE = [f"Site line {i}" for i in range(10)]


def plain(*own, site=SITE, extra=""):
    return "".join(f"<div>{t}</div>" for t in site) + extra + "".join(f"<p>{t}</p>" for t in own)


def test_short_articles_lose_the_site(spark):
    rows = [(i, f"http://h/{i:03d}", plain(f"own {i}", f"more {i}")) for i in range(9)]
    rows += [(20 + i, f"http://two/{i}", plain(f"own {i}", f"more {i}")) for i in range(2)]
    got = {r.page_id: (r.text, r.n_shared) for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {**{i: (f"own {i}\nmore {i}", 10) for i in range(9)}, **{20 + i: (f"own {i}\nmore {i}", 10) for i in range(2)}}


@pytest.mark.parametrize("block", [3, 512])
def test_runs_of_copies_lose_the_site(spark, monkeypatch, block):
    monkeypatch.setattr(html, "BLOCK", block)
    story = lambda k: [f"story {k} {j}" for j in range(12)]
    rows = [(i, f"http://h/a{i:03d}", plain(*story("a"), extra=f"<nav>advert {i}</nav>" * (i % 3))) for i in range(9)]
    rows += [(20, "http://h/0", plain(*story("0"))), (21, "http://h/b", plain(*story("b"))), (22, "http://h/c", plain(*story("c")))]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {**{i: "\n".join(story("a")) for i in range(9)}, **{20 + i: "\n".join(story(k)) for i, k in enumerate("0bc")}}


def test_altered_copies_keep_their_article(spark):
    story = lambda k: [f"story {k} {j}" for j in range(12)]
    rows = [(1, "http://h/a", plain(*story("a"))), (2, "http://h/a-print", plain(*story("a"), "printed")),
            (3, "http://h/b", plain(*story("b"))), (4, "http://h/c", plain(*story("c")))]
    got = {r.page_id: r.text.split("\n") for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: story("a"), 2: [*story("a"), "printed"], 3: story("b"), 4: story("c")}


def test_a_page_without_own_lines_keeps_its_text(spark):
    rows = [(i, f"http://h/{i}", plain(f"own {i}")) for i in range(4)] + [(9, "http://h/9", plain())]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {**{i: f"own {i}" for i in range(4)}, 9: "\n".join(SITE)}


def test_empty_and_long(spark):
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "<article>" + "<p>" + "word " * 200_000 + "</p>" + "<div>" * 3000 + "deep"
    got = html.extract(spark.createDataFrame([(1, "http://a/b", long), (2, "http://a/c", "<" * 20_000)], SCHEMA)).collect()
    assert {r.page_id: r.n_chars for r in got}[1] == 5 * 200_000 - 1 + 5


def test_what_is_left_decides_where_articles_are_unmarked(spark, table):
    pages = table("pages").select("page_id", "url", "html")
    marked = {r.page_id: r.text for r in html.extract(pages).collect()}
    renamed = pages.withColumn("html", F.regexp_replace("html", "(</?)article>", "$1div>"))
    assert {r.page_id: r.text for r in html.extract(renamed).collect()} == marked


@pytest.mark.parametrize("page,want", [
    ("<article><h2>Teaser</h2></article><div><p>The real story...</p><p>It goes on.</p></div>", "The real story...\nIt goes on."),
    ("<article><h2>Teaser</h2></article><div><p>The real story...</div>", "The real story..."),
    ("<article><p>a</p><div class='share-story'>b</div><section class='comments-on-policy'>c</section><div class='share-links'>d</div></article>", "a\nb\nc"),
    ("<article><p>in</p><div id='ad_slot-3'>buy</div><div class='big sidebar-left'>s</div><p class='related-work'>w</p></article>", "in\nw"),
    ("<div><p>one line</p><p>another line</p><p>and a third line</p><div>fourth</div></div><div>x</div>", "one line\nanother line\nand a third line\nfourth"),
])
def test_content(page, want):
    assert text(page) == want


def test_content_keeps_its_shared_lines():
    page = "<div><ul><li>Site<li>Home</ul><h1>Title</h1><p>quoted</p><p>a long line of its own</p><div>said</div><p>another long line</p></div><p>x</p>"
    assert text(page, [0, 1, 3, 5]) == "Title\nquoted\na long line of its own\nanother long line"
    assert html.main_text(page, [0, 1, 3, 5], [0, 1]) == "Title\nquoted\na long line of its own\nsaid\nanother long line"
    assert text("<div>Site</div><p>y</p>", [0, 1]) == "Site\ny"
    assert text("<article><p>a</p></article>", [0]) == "a"


@pytest.mark.parametrize("page", [
    "<b>" * 20_000 + "</i>" * 20_000 + "x",
    "<p>" + "<b>" * 20_000 + "<em></em>" * 20_000,
    "<li><ul>" + "<b>" * 20_000 + "<li></li>" * 20_000,
    "<div>" * 20_000 + "x",
])
def test_parsing_is_linear(page):
    start = time.process_time()
    html.main_text(page, [])
    assert time.process_time() - start < 3


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("cells", [1 << 28, 8])
def test_alignment(monkeypatch, cells):
    monkeypatch.setattr(html, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(400):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(15))] for _ in range(2))
        places = html.common(a, b)
        rest = iter(b)
        assert places == sorted(set(places)) and all(a[i] in rest for i in places) and len(places) == longest(a, b)


def test_nearness():
    assert html.nearness("/a/b/c", "/a/b/d") == 3 and html.nearness("/a", "/b") == 1 and html.nearness("", "") == 1
