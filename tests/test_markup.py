"""Reading stored pages: nesting, quotes, entities, unclosed elements."""

import time

import pytest
from pyspark.sql import functions as F

from rimsight.functions import markup as m
from rimsight.operators import pages


def read(source):
    page = m.Page(source)
    return page, [(t, page.text_of(k)) for k, t in enumerate(page.tag) if t]


def test_unclosed_elements_end_where_they_should():
    page, found = read("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>e<p>f<div>g</div>")
    assert found == [("ul", "abcd"), ("li", "a"), ("li", "bc"), ("ul", "c"), ("li", "c"), ("li", "d"), ("p", "e"), ("p", "f"), ("div", "g")]
    page, found = read("<table><tr><td>1<td>2<tr><th>3</table>")
    table = page.tagged("table")[0]
    assert [[page.text_of(c) for c in page.cells(r)] for r in page.rows(table)] == [["1", "2"], ["3"]]


def test_nested_tables_keep_their_rows():
    page, _ = read("<table><tbody><tr><td>a<table><tr><td>b</td><td>c</td></tr></table></td><td>d</td></tr></tbody></table>")
    outer, inner = page.tagged("table")
    assert [[page.text_of(c) for c in page.cells(r)] for r in page.rows(outer)] == [["abc", "d"]]
    assert [[page.text_of(c) for c in page.cells(r)] for r in page.rows(inner)] == [["b", "c"]]


def test_a_closing_tag_inside_a_table_does_not_end_what_stands_outside():
    page, found = read("<div>a<table><tr><td>b</div>c</td></tr></table>d</div>e")
    assert found[0] == ("div", "abcd")


def test_quotes_entities_scripts_and_loose_signs():
    page, _ = read("<a TITLE='x > \"y\"' href = /p?a=1&amp;b=2 class=\"k  l\">1 < 2 &lt; &#51; &nbsp;&eacute;&#x41;</a><script>if (a < b) '<b>no</b>'</script><!-- <b>no</b> --><br/>z")
    link = page.tagged("a")[0]
    assert page.attrs[link] == {"title": 'x > "y"', "href": "/p?a=1&b=2", "class": "k  l"}
    assert page.text_of(link) == "1 < 2 < 3  éA"
    assert page.tagged("b") == [] and page.classed("l") == [link] and page.tag[-1] == "" and page.text[-1] == "z"
    assert page.tagged("script") and page.text_of(page.tagged("script")[0]) == ""


@pytest.mark.parametrize("source", ["", "<", "<<<a", "<a href='", "</p></x>", "<!--", "<script>", "text only", "<a b=c", "<p><b></p></b>"])
def test_broken_pages_do_not_fail(source):
    page = m.Page(source)
    n = len(page.tag)
    assert len(page.last) == len(page.text) == len(page.scope) == n
    assert all(k <= page.last[k] < n for k in range(n))


def test_time_grows_with_the_page():
    piece = "<div class='a'><p>text <b>bold</b><ul><li>x<li>y</ul></div><a \"></a><"
    spent = []
    for size in (400, 1600):
        start = time.perf_counter()
        m.Page(piece * size)
        spent.append(time.perf_counter() - start)
    assert spent[1] < 16 * spent[0] + 0.5


def test_text_for_screen_readers():
    page, _ = read("<p><span class='x sr-only'>No <i>1</i></span>7</p>")
    assert page.text_of(0) == "7" and page.text_of(0, everything=True) == "No 17"


def test_null_and_empty_pages(spark):
    made = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, "u", "<table></table><li class='player-card'></li>")], "page_id long, url string, html string")
    found = m.parsed(made, ["page_id"], "array<string>", lambda page: page.tag)
    assert {r["page_id"]: r["found"] for r in found.collect()} == {1: None, 2: [], 3: ["table", "li"]}
    for read_pages in (pages.table_rows, pages.player_cards, pages.coach_cards, pages.coach_table_rows, pages.labelled_cards):
        assert read_pages(made).collect() == []
    assert pages.sectioned_list(made, "x").collect() == [] and pages.page_links(made, ".").collect() == []
    assert {r["page_id"]: r["v"] for r in pages.list_fields(made, {"v": "V"}).collect()}[3] == ""


def test_cards_of_wrapped_text_and_shared_elements(spark):
    html = (
        "<ul><li><div class='text-wrapper'><h3><a href='/roster/7' aria-label='Bo - bio'>Bo <b>Li</b></a></h3></div><span class='hometown'>Rom</span></li></ul>"
    )
    made = spark.createDataFrame([(1, "https://t.edu/x", html)], "page_id long, url string, html string")
    row = pages.player_cards(made).first()
    assert (row["name"], row["hometown"], row["url"]) == ("Bo Li", "Rom", "https://t.edu/roster/7")
    coach = html.replace("text-wrapper", "sidearm-roster-coach").replace("hometown", "title")
    staff = pages.coach_cards(made.withColumn("html", F.lit(coach))).first()
    assert (staff["name"], staff["title"]) == ("Bo Li", "")


def test_pages_of_one_template_share_their_tree():
    def source(name, link, css="k"):
        return f"<table><tr><td class='{css}'>{name}</td><td><a href='{link}' title=\"a > b\">x</a></td></tr></table>"

    one, two = m.Page(source("Zo&euml;", "/p/1")), m.Page(source("Ann", "/p/2"))
    assert one.shape is two.shape
    assert [(p.text_of(c), p.href(r)) for p in (one, two) for r in p.rows(0) for c in p.cells(r)[:1]] == [("Zoë", "/p/1"), ("Ann", "/p/2")]
    assert one.attrs[p0 := one.tagged("a")[0]]["href"] == "/p/1" and two.attrs[p0]["href"] == "/p/2"
    # another class, an empty text or a closing sign is another tree
    assert len({id(m.Page(t).shape) for t in (source("a", "/"), source("", "/"), source("a", "/", "sr-only"), source("a", "/").replace("x</a>", "x<br/></a>"))}) == 4
    assert m.Page(source("a", "/", "sr-only")).text_of(0) == "x"


def test_trees_kept_are_bounded():
    for i in range(300):
        m.Page("<div>" * 300 + f"<p class='c{i}' id='{i}'>t</p>")
    assert m._SHAPES.nodes <= m.Shapes.NODES + 400 and len(m._SHAPES.numbers) <= m.Shapes.MARKS + 400
    assert m.Page("<p class='c1' id='7'>t</p>").by_id("7") == 0


def test_labels_removed_at_once_as_one_by_one(spark):
    """Every text of three label pieces, against the patterns one after another."""
    import itertools
    import re

    from rimsight.functions import roster

    pieces = ["Hometown / High School: ", "HIGH SCHOOL/", "Previous School: ", "Class: ", "Hometown", "No.: ", "Town, OH / HS", "school: a", "High ", "Hometown: ", " : ", "Hometown/High School (Former School):"]
    texts = sorted({"".join(p) for n in (1, 2, 3) for p in itertools.product(pieces, repeat=n)})

    def one_by_one(text):
        for pattern in roster.LABEL_PATTERNS:
            text = re.sub(f"(?i){pattern}", "", text).strip(" \t\n\x0b\f\r")
        return text

    made = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    got = {r["t"]: r["u"] for r in made.select("t", roster._unlabelled(F.col("t")).alias("u")).collect()}
    assert {t: u for t, u in got.items() if u != one_by_one(t)} == {}
    plain = ["", "Ann", "Ann Lee", "Ann  Lee", " Ann", "Ann Lee Ann Lee", "a Full Bio x", "Instagram", "b\u0085Twitter", "hoMetown", "a\n", "a b c", "a:b"]
    cleaned = spark.createDataFrame([(t,) for t in plain], "t string").select("t", roster.clean(F.col("t")).alias("u")).collect()
    want = ["", "Ann", "Ann Lee", "Ann Lee", "Ann", "Ann Lee", "a", "", "b\u0085", "", "a", "a b c", "a:b"]
    assert [r["u"] for r in cleaned] == want


def test_rows_of_one_kind_are_looked_up_once_whatever_the_page(monkeypatch):
    """Pages of ever other numbers of rows share no tree, but their rows share what was found in them."""
    m._SHAPES.clear()
    asked = []
    shows = pages._shows
    monkeypatch.setattr(pages, "_shows", lambda classes: asked.append(classes) or shows(classes))
    kinds = ["<tr><td>{0}</td><td class='d-none'>x</td><td><a href='/p/{0}'>n{0}</a> m</td></tr>", "<tr><td><b>b</b>{0}</td></tr>"]
    for n in range(1, 40):
        rows = [kinds[(k * n) % 3 % 2].format(k) for k in range(n)]
        found = pages._first_table(m.Page("<table><tr><th>N</th></tr>" + "".join(rows) + "</table>"))
        want = [{"cells": [str(k), f"n{k} m"], "link": f"/p/{k}"} if "n{0}" in kinds[(k * n) % 3 % 2] else {"cells": [f"b{k}"], "link": ""} for k in range(n)]
        assert found == {"headers": ["N"], "rows": want}
    assert len(asked) == 4


def test_text_hidden_around_a_row_is_no_other_rows_text():
    card = "<li class='player-card'><h3><a href='/roster/1'>Ann</a></h3></li>"
    found = [pages._player_cards(m.Page(f"<div class='{css}'>{card}</div>"))[0]["names"] for css in ("k", "sr-only", "k")]
    assert found == [["Ann"], [""], ["Ann"]]


def test_plain_pages_are_cut_as_by_the_pattern():
    import random

    pieces = ["<", ">", '"', "'", "=", "/", " ", "a", "<a href=\"x\">", "<a href='1' b=\"&lt;\">", '<a"b c"d>', "</a>", "<!-- c -->", "<!x>", "<li class=\"k\">", "<li CLASS=\"k l\" id=\"3\"/>",
              "<a\nhref = \"z\" HREF=\"y\">", "text", "<br/>", "<a x>", "<a x=\"1\"y=\"2\">", "<p title=\"a > b\">", "</p>"]
    pick = random.Random(3)
    for _ in range(4000):
        source = "".join(pick.choices(pieces, k=pick.randint(0, 12)))
        page = m.Page(source)
        whole, own, words = m.Shapes(), [], []
        head, *codes = whole._any(source, own, words)
        kinds = [whole.kinds[c >> 1] for c in codes]
        shape = m.Shape(kinds, [bool(head), *[bool(c & 1) for c in codes]], tuple(codes), "sr-only")
        assert (page.tag, page.last, page.scope) == (shape.tag, shape.last, shape.scope), source
        assert [page.attrs[k] for k in shape.own] == own and page.words == [m._decoded(w) for w in words], source
