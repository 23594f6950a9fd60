import html
import re

from tidewater.llm import extract as X
from tidewater.llm.queries import REGISTRY


def test_pages_of_the_tables(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = REGISTRY["op6_html_extraction"](spark, sf).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        article = re.sub(r"</?b>", "", re.sub(r"<(?:/?p|br|/?h1)>", " ", article))
        assert r.text == " ".join(html.unescape(article).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def page(i, body):
    return f'<html><body><div class="top"><div>The Daily Site</div><p>since 1900</p></div><div class="story">{body}</div><div class="bottom"><p>imprint and terms</p></div></body></html>'


def test_constant_nodes_are_template(spark):
    rows = [(i, f"http://Site.example/{i}", page(i, f"<p>story {i} begins</p><p>and number {i} ends &amp; more</p>")) for i in range(8)]
    rows += [(100 + i, f"http://few.example/{i}", page(i, f"<p>text {i}</p>")) for i in range(3)]  # too few for evidence
    rows += [(200 + i, f"http://same.example/{i}", page(0, "<p>always the same page</p>")) for i in range(9)]  # copies are one page
    got = {r.page_id: r.text for r in X.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == f"story {i} begins and number {i} ends & more"
    assert got[101] == "The Daily Site since 1900 text 1 imprint and terms"
    assert "always the same page" in got[200]


def test_a_page_with_an_extra_node_still_aligns(spark):
    rows = [(i, f"//h.example/{i}", page(i, f"<h2>head {i}</h2><p>body {i}</p>" if i % 3 else f"<table><tr><td>cell {i}</table><h2>head {i}</h2><p>body {i}</p>")) for i in range(9)]
    got = {r.page_id: r.text for r in X.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "head 1 body 1" and got[3] == "cell 3 head 3 body 3"


def test_marks_and_broken_markup():
    text = lambda h: X.main_text(h, None, set(), {})
    assert text("") == "" and text("plain <b>te</b>xt &amp; more") == "plain text & more"
    assert text('<nav>menu</nav><article><p>one<p>two<ul><li>a<li>b</ul><aside>no</aside></article><div>after</div>') == "one two a b"
    assert text('<div class="sidebar-left">x</div><p>keep</p><div id="comments"><p>reader</p></div><form>f</form><p>also') == "keep also"
    assert text("<p>a<script>if (a<b) '</p>'</script>b</p><style>p{}</style><!-- c --><p>c&nbsp;d &lt;x&gt;") == "ab c d <x>"
    assert text('<p title="a>b">quoted</p><a href="x>open') .startswith("quoted")
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep" and text("<p>cut off <b") == "cut off"


def test_tree_matching():
    a = ["", [["div", [["p", []], ["ul", [["li", []]]]]], ["footer", []]]]
    b = ["", [["header", []], ["div", [["h1", []], ["p", []], ["ul", [["li", []]]]]], ["footer", []]]]
    assert X.align(a, b) == {0: 0, 1: 2, 2: 4, 3: 5, 4: 6, 5: 7}
    assert X.align(["x", []], ["y", []]) == {}


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a.b/c", "<p>x"), (3, "not a url", ""), (3, "not a url", ""), (4, "HTTP://A.b:80/", "<p>y</p>")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, host string, template int")
    got = sorted(((r.page_id, r.text) for r in X.extracted(df).collect()), key=str)
    assert got == sorted([(1, ""), (None, "x"), (3, ""), (3, ""), (4, "y")], key=str)
    assert X.extracted(df.limit(0)).count() == 0


def test_deep_nests_keep_what_follows_and_their_marks():
    text = lambda h: X.main_text(h, None, set(), {})
    for depth in (1, 50, 56, 57, 58, 59, 70, 400):
        nest = "<div>" * depth
        assert text(f"<body><div><article><p>one</p>{nest}two{'</div>' * depth}<p>three</p></article></div><p>out</p></body>") == "one two three"
        marked = '<nav>menu</nav><div class="advert">buy<p>now</p></div><div id="comments">reader</div><p>kept</p>'
        assert text(f"<div>{nest}{marked}{'</div>' * depth}</div><p>end</p>") == "kept end"
        assert text(f"<p>before</p>{nest}<article><p>deep</p></article>{'</div>' * depth}<p>after</p>") == "deep"
        assert text(f"{nest}<p>a<p>b</section></article>{'</div>' * depth}<ul><li>c<li>d</ul>") == "a b c d"
