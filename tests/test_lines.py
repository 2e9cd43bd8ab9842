"""Transfer lines of pages: each entry is worked out once, whatever the page's length and its letters' case."""

import re

from pyspark.sql import functions as F

from rimsight.functions import html as h
from rimsight.functions.strings import squish
from rimsight.operators import pages

LINE = '<H2>Team\t 1</H2><h2 class="x">Back to page 2</h2><p>{status}<strong>• Ann Lee</strong>, 6-1  JR G, Town, OH {{entered portal 4/2/25}}<br />plain</p>'


def _pages(spark, *bodies):
    return spark.createDataFrame([(k, "u", b) for k, b in enumerate(bodies)], "page_id long, url string, html string")


def test_entry_is_in_the_plan_once(spark, capsys):
    pages.sectioned_lines(_pages(spark, "")).explain()
    plan = capsys.readouterr().out
    assert plan.count("^[•\\s]+") == 1
    assert "upper(" not in plan


def test_status_in_any_case(spark):
    under = '<span style="text-decoration: underline">{}</span><br>'
    bodies = [LINE.format(status=under.format(w)) for w in ("iN", " ıN ", "oUt", "Inn", "")]
    got = {r.page_id: (r.team, r.status, r.name, r.hometown, r.entered_portal) for r in pages.sectioned_lines(_pages(spark, *bodies, None, "")).collect()}
    rest = ("Ann Lee", "Town, OH", "2025-04-02")
    assert got == {0: ("Team 1", "In", *rest), 1: ("Team 1", "In", *rest), 2: ("Team 1", "Out", *rest)}


def test_long_blocks_and_their_ends(spark):
    bold = "<b>x</b>y\n" * 100_000
    html = f"<P>{bold}</P><p class='a'>one<p>two</p></p><pre>no</pre><h2>open"
    got = _pages(spark, html).select(h.blocks(F.col("html"), "h2", "p").alias("b"), h.inner(F.col("html"), "p").alias("i")).first()
    assert got.b == [f"<P>{bold}</P>", "<p class='a'>one<p>two</p>"]
    assert got.i == [bold, "one<p>two"]


def test_squish_leaves_what_strip_and_runs_leave(spark):
    texts = ["", " ", "\t", "a b", " a  b ", "a\tb", "a \n\x0b\f\r b\t ", "a\xa0 b", "\n\n", "a  "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", squish("t").alias("s")).collect()
    assert all(r.s == " ".join(w for w in re.split(r"[ \t\n\x0b\f\r]+", r.t) if w) for r in rows)
