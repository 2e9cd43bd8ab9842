"""Stored pages: the given pages, and pages written from the rows of each order."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.functions import html as h
from rimsight.functions.urls import history_team_id, link_game_id
from rimsight.operators import pages
from rimsight.plans.registry import query
from rimsight.plans.sqltext import pick, pick_sql, quoted, squish_sql, strip_sql
from rimsight.plans.standins import line_tasks, table


def with_tail(spark, d, tails):
    """The given pages with one of several fragments appended by page id."""
    return table(spark, d, "pages").select("page_id", "url", F.concat("html", pick("page_id", tails)).alias("html"))


def decode_sql(expr):
    for entity, plain in h.ENTITIES:
        expr = f"replace({expr}, {quoted(entity)}, {quoted(plain)})"
    return expr


def text_sql(expr, separator=""):
    return decode_sql(f"regexp_replace({expr}, '(?s)<[^>]*>', '{separator}', 'g')")


SEASON_TAILS = [
    "<h2>2024-25 Women's Basketball ROSTER</h2>", "<h1 class=\"x\"><b>2024 - 2025</b> roster</h1>", "<h2>2024-2025 Coaches</h2>", "<h3>2024-25 roster</h3>", "",
]


@query(
    "h1_season_check",
    """SELECT page_id, page_id % 5 IN (0, 1) AS players, page_id % 5 IN (0, 1, 2) AS coaches FROM pages""",
)
def h1(spark, d):
    season, html = F.lit("2024-25"), F.col("html")
    return with_tail(spark, d, SEASON_TAILS).select(
        "page_id",
        pages.season_shown(html, season, F.lit(True)).alias("players"),
        pages.season_shown(html, season, F.lit(False)).alias("coaches"),
    )


MARKS = ['<div class="a sidearm-x">', '<li id="3" class="sidearm-roster-player active">', '<li class="sidearm-roster-player-name">', "<p>sidearm</p>"]


@query("h2_platform_detection", "SELECT page_id, page_id % 4 IN (0, 1) AS is_sidearm FROM pages")
def h2(spark, d):
    return with_tail(spark, d, MARKS).select("page_id", pages.is_sidearm(F.col("html")).alias("is_sidearm"))


@query(
    "h4_page_links",
    f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)(<a\\s[^>]*>.*?</a>)', 1)) AS t FROM pages),
    b AS (SELECT page_id, url, regexp_extract(t, '(?is)\\shref="([^"]*)"', 1) AS href, {strip_sql(text_sql('t'))} AS text FROM a)
    SELECT page_id, text, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS link, CAST(NULL AS VARCHAR) AS link_id FROM b WHERE regexp_matches(href, '^/[A-Za-z]+$')""",
)
def h4(spark, d):
    return pages.page_links(table(spark, d, "pages"), "^/[A-Za-z]+$")


TEAM_LINKS = ['<a class="x" href="/teams/', '<a href="https://stats.org/teams/', '<a href="/team/']


@query(
    "h4_team_links",
    f"""SELECT page_id, 'Team ' || page_id AS text, CASE page_id % 3 WHEN 0 THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) ELSE 'https://stats.org' END || '/teams/' || page_id AS link,
      CAST(page_id AS VARCHAR) AS link_id FROM pages WHERE page_id % 3 < 2""",
)
def h4_teams(spark, d):
    n = F.col("page_id").cast("string")
    tail = F.concat(pick("page_id", TEAM_LINKS), n, F.lit('"> <b>Team '), n, F.lit("</b></a>"))
    made = table(spark, d, "pages").select("page_id", "url", F.concat("html", tail).alias("html"))
    return pages.page_links(made, r"/teams/\d+")


IDS = ['<a href="https://wmt.games/x/stats/match/full/7{n}">g</a>', "<script>go('/stats/match/8{n}')</script>", "<script>go('/stats/match/full/9{n}')</script>", "<p>none</p>"]


@query(
    "h5_game_id",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN '7' || page_id WHEN 1 THEN '8' || page_id WHEN 2 THEN '9' || page_id END AS match_id,
      CASE page_id % 3 WHEN 0 THEN '55' || page_id WHEN 1 THEN '66' || page_id END AS link_id FROM pages""",
)
def h5(spark, d):
    n = F.col("page_id").cast("string")
    tail = F.replace(pick("page_id", IDS), F.lit("{n}"), n)
    link = F.concat(pick("page_id", ["/boxscore/55", "/boxscore?id=66", "/boxscore/none="]), n, pick("page_id", ["/", "&path", "x"]))
    made = table(spark, d, "pages").select("page_id", F.concat("html", tail).alias("html"), link.alias("link"))
    return made.select("page_id", pages.match_id(F.col("html")).alias("match_id"), link_game_id(F.col("link")).alias("link_id"))


@query(
    "h6_label_list_items",
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'Town ' || page_id ELSE '' END AS hometown, '6-' || page_id % 10 AS height FROM pages""",
)
def h6(spark, d):
    n = F.col("page_id").cast("string")
    town = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<li><b>Hometown:</b> Town "), n, F.lit("</li>"))).otherwise("<li>My Hometown: x</li>")
    tail = F.concat(F.lit("<ul>"), town, F.lit('<li class="k">Height: 6-'), (F.col("page_id") % 10).cast("string"), F.lit("</li></ul>"))
    made = table(spark, d, "pages").select("page_id", F.concat("html", tail).alias("html"))
    return pages.list_fields(made, {"hometown": "Hometown", "height": "Height"})


@query(
    "h8_visible_text",
    f"""SELECT page_id, {squish_sql(text_sql(f"regexp_replace(html, {quoted(h.HIDDEN_PARTS)}, ' ', 'g')", ' '))} AS text FROM pages""",
)
def h8(spark, d):
    return pages.extract_or_miss(table(spark, d, "pages"))[0].select("page_id", "text")


@query("h8_pages_without_text", "SELECT page_id, url FROM pages WHERE page_id % 5 = 2")
def h8_missing(spark, d):
    empty = table(spark, d, "pages").withColumn("html", F.when(F.col("page_id") % 5 == 2, "<nav>menu</nav><script>x</script>").otherwise(F.col("html")))
    return pages.extract_or_miss(empty)[1]


@query("h12_hidden_value", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'id' || page_id END AS master_id FROM pages")
def h12(spark, d):
    n = F.col("page_id").cast("string")
    kinds = ['<form id="sit_stat_form_id" x="1"><input type="hidden" id="stats_player_seq_field_id" value="id', '<form id="other"><input id="stats_player_seq_field_id" value="id', '<form id="sit_stat_form_id"><input id="else" value="id']
    tail = F.concat(pick("page_id", kinds), n, F.lit('"></form>'))
    made = table(spark, d, "pages").select("page_id", F.concat("html", tail).alias("html"))
    return pages.hidden_value(made, "sit_stat_form_id", "stats_player_seq_field_id").withColumnRenamed("value", "master_id")


@query("h14_history_team_id", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'w' || page_id ELSE '' END AS master_team_id, CAST(2000 + page_id % 20 AS VARCHAR) AS year, CAST(page_id % 3 + 1 AS VARCHAR) AS division FROM pages")
def h14(spark, d):
    n = F.col("page_id").cast("string")
    link = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/teams/history/WBB/w"), n)).otherwise(F.concat(F.lit("/teams/"), n))
    file = F.concat(F.lit("teams_"), (F.col("page_id") % 20 + 2000).cast("string"), F.lit("_d"), (F.col("page_id") % 3 + 1).cast("string"), F.lit(".csv"))
    made = table(spark, d, "pages").select("page_id", F.concat(F.lit('<a href="'), link, F.lit('">h</a>')).alias("html"), file.alias("file"))
    return made.select(
        "page_id",
        history_team_id(h.first_link(F.col("html"))).alias("master_team_id"),
        F.regexp_extract("file", r"^teams_(\d+)_d(\d+)\.csv$", 1).alias("year"),
        F.regexp_extract("file", r"^teams_(\d+)_d(\d+)\.csv$", 2).alias("division"),
    )


def line_pages(spark, d, row, head="", tail="", joiner=""):
    """One page per order with one fragment per line; an order has a handful of lines."""
    item = F.struct("l_linenumber", "l_partkey", row.alias("r"))
    body = F.transform(F.array_sort(F.collect_list(item)), lambda s: s["r"])
    # the narrow lines are dealt out, not lists of their long fragments
    dealt = table(spark, d, "lineitem").repartition(line_tasks(spark, d), "l_orderkey")
    made = dealt.groupBy(F.col("l_orderkey").alias("page_id")).agg(F.array_join(body, joiner).alias("b"))
    return made.select("page_id", F.lit("https://t.edu/sports/wbb/roster").alias("url"), F.concat(F.lit(head), "b", F.lit(tail)).alias("html"))


def text(name):
    return F.col(name).cast("string")


TABLE_HEAD = (
    "<h1>x</h1><table class=\"r\"><thead><tr><th>No.</th><th>Name</th><th>Pos.</th><th></th><th>Cl.</th><th>Hometown / High School</th><th>Social</th></tr></thead><tbody>"
)


@query(
    "h3_table_rows",
    """SELECT l_orderkey AS page_id, CAST(l_linenumber AS VARCHAR) AS jersey, 'P & ' || l_suppkey AS name, l_returnflag AS position, '' AS height, 'Sophomore' AS academic_year,
      'Town' || l_partkey || ', OH' AS hometown, 'HS ' || l_linenumber AS high_school, '' AS previous_school, 'https://t.edu/roster/p/' || l_partkey AS url
    FROM lineitem WHERE l_returnflag <> 'N'""",
)
def h3(spark, d):
    short = F.when(F.col("l_returnflag") == "N", "").otherwise(
        F.concat(F.lit("<td> Hometown / High School: Town"), text("l_partkey"), F.lit(", OH / HS "), text("l_linenumber"), F.lit("</td>"))
    )
    row = F.concat(
        F.lit("<tr><td>"), text("l_linenumber"), F.lit('</td><td><a href="/roster/p/'), text("l_partkey"), F.lit('">P &amp; '), text("l_suppkey"),
        F.lit(' </a></td><td class="x d-none">dup</td><td class="d-none d-md-table-cell">'), F.col("l_returnflag"),
        F.lit('</td><td>-</td><td>Class: So.</td>'), short, F.lit("</tr>"),
    )
    return pages.table_rows(line_pages(spark, d, row, TABLE_HEAD, "</tbody></table><table><tr><td>other</td></tr></table>")).withColumn(
        "academic_year", F.when(F.col("academic_year") == "Sophomore", "Sophomore").otherwise(F.concat(F.lit("?"), "academic_year"))
    )


@query(
    "h7_embedded_people",
    """SELECT l_orderkey AS page_id, CAST(l_partkey AS VARCHAR) AS player_id, 'Ann Lee-' || l_suppkey AS name, 'Junior' AS academic_year, 'Town' || l_linenumber AS hometown, '' AS high_school,
      '' AS previous_school, CASE WHEN l_returnflag = 'A' THEN '6''' || l_linenumber || '"' ELSE '' END AS height, l_returnflag AS position, CAST(l_linenumber AS VARCHAR) AS jersey,
      'https://t.edu/sports/womens-basketball/roster/ann-lee-' || l_suppkey || '/' || l_partkey AS url FROM lineitem""",
)
def h7(spark, d):
    tall = F.when(F.col("l_returnflag") == "A", F.concat(F.lit('"height_feet": 6, "height_inches": '), text("l_linenumber"), F.lit(", "))).otherwise("")
    row = F.concat(
        F.lit('{"first_name": "Ann", "last_name": "Lee-'), text("l_suppkey"), F.lit('", "rp_id": '), text("l_partkey"), F.lit(', "academic_year_short": "Jr.", '), tall,
        F.lit('"hometown": "Town'), text("l_linenumber"), F.lit('", "previous_school": null, "position_short": "'), F.col("l_returnflag"), F.lit('", "jersey_number": '),
        text("l_linenumber"), F.lit("}"),
    )
    made = line_pages(spark, d, row, '<script>window.x = {roster: {"players": [', '], "coaches": []}, roster_settings: {}}</script>', ",")
    return pages.embedded_rows(made)


@query(
    "h7_embedded_coaches",
    """SELECT l_orderkey AS page_id, CAST(l_partkey AS VARCHAR) AS player_id, 'Bo ' || l_suppkey AS name, 'Coach ' || l_returnflag AS position,
      'https://t.edu/sports/womens-basketball/roster/coaches/bo-' || l_suppkey || '/' || l_partkey AS url FROM lineitem""",
)
def h7_coaches(spark, d):
    row = F.concat(
        F.lit('{"first_name": "Bo", "last_name": "'), text("l_suppkey"), F.lit('", "rp_id": "'), text("l_partkey"), F.lit('", "title": "Coach '), F.col("l_returnflag"), F.lit('"}')
    )
    return pages.embedded_rows(line_pages(spark, d, row, 'roster: {"players": [], "coaches": [', "]}, roster_settings: 1", ","), coaches=True)


@query(
    "h9_sectioned_list",
    """SELECT l_orderkey AS page_id, CASE WHEN l_returnflag = 'A' THEN 'Jobs Open' ELSE 'Jobs Filled' END AS status, 'School ' || l_suppkey AS school,
      CASE WHEN l_linestatus = 'O' THEN 'Big ' || l_linenumber ELSE '' END AS conference, 'Coach ' || l_partkey AS coach,
      CASE WHEN l_returnflag = 'A' THEN 'departed' ELSE 'hired' END AS role,
      'Coach ' || l_partkey || CASE WHEN l_returnflag = 'A' THEN ' resigned' ELSE ' named coach' END || ' (March ' || l_linenumber || ', 2024)' AS text,
      '2024-03-0' || l_linenumber AS date, 'https://a.edu/' || l_partkey AS url FROM lineitem WHERE l_returnflag <> 'N'""",
)
def h9(spark, d):
    status = F.when(F.col("l_returnflag") == "A", "JOBS OPEN").when(F.col("l_returnflag") == "R", "2024 jobs filled").otherwise("Rumours")
    school = F.when(F.col("l_linestatus") == "O", F.concat(F.lit(" (Big "), text("l_linenumber"), F.lit(")"))).otherwise("")
    row = F.concat(
        F.lit("<h2>"), status, F.lit("</h2><ul><li>no school yet</li></ul><h3>School "), text("l_suppkey"), school, F.lit("</h3><ul><li><strong>Coach "), text("l_partkey"),
        F.lit("</strong>"), F.when(F.col("l_returnflag") == "A", " resigned").otherwise(" <i>named</i> coach"), F.lit(" (March "), text("l_linenumber"),
        F.lit(', 2024 ) <a href="https://blog.example.com/x"></a><a href="https://a.edu/'), text("l_partkey"), F.lit('"></a></li></ul>'),
    )
    return pages.sectioned_list(line_pages(spark, d, row), "blog.example.com")


@query(
    "h10_sectioned_lines",
    """SELECT l_orderkey AS page_id, 'Team ' || l_suppkey AS team, CASE WHEN l_returnflag = 'A' THEN 'In' ELSE 'Out' END AS status, 'P' || l_partkey AS name,
      '6-' || l_linenumber AS height, 'JR' AS year, 'G' AS position, 'Town, OH' AS hometown, '2025-04-0' || l_linenumber AS entered_portal, CAST(NULL AS VARCHAR) AS transfer_history
    FROM lineitem WHERE l_returnflag <> 'N'""",
)
def h10(spark, d):
    status = F.when(F.col("l_returnflag") == "A", '<span style="text-decoration: underline">In</span><br>').when(
        F.col("l_returnflag") == "R", '<span style="text-decoration:underline;">OUT</span><br/>').otherwise("")
    row = F.concat(
        F.lit("<h2>Team "), text("l_suppkey"), F.lit("</h2><h2>Back to page 2</h2><p>"), status, F.lit("<strong>• P"), text("l_partkey"), F.lit("</strong>, 6-"), text("l_linenumber"),
        F.lit(" JR G, Town, OH → Dest {entered portal 4/"), text("l_linenumber"), F.lit("/25}<br />plain line</p>"),
    )
    return pages.sectioned_lines(line_pages(spark, d, row))


@query(
    "w11_carry_forward",
    """SELECT l_orderkey AS page_id, count(*) AS items, count(DISTINCT l_suppkey) AS schools FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1""",
)
def w11(spark, d):
    school = F.concat(F.lit("School "), text("l_suppkey"))
    row = F.concat(
        F.lit("<h2>"), F.when(F.col("l_returnflag") == "N", "Other").otherwise("Jobs open"), F.lit("</h2><h3>"), school, F.lit("</h3><ul><li>x</li></ul>")
    )
    rows = pages.sectioned_list(line_pages(spark, d, row), "b")
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("items"), F.countDistinct("school").alias("schools"))


def player_card_row():
    link = F.when(F.col("l_returnflag") == "N", "/roster/staff/").otherwise("/roster/")
    name = F.when(F.col("l_linestatus") == "O", "").otherwise(F.concat(F.lit("Ana "), text("l_suppkey")))
    return F.concat(
        F.lit('<li class="sidearm-roster-player c"><div class="sidearm-roster-player-name"><span>#9</span><h3><a href="'), link, text("l_partkey"), F.lit('" aria-label="Bea '),
        text("l_suppkey"), F.lit(' jersey number 9 full bio">'), name, F.lit('</a></h3></div><span class="sidearm-roster-player-jersey"><span class="sr-only">Jersey Number</span> '),
        text("l_linenumber"), F.lit('</span><span class="text sidearm-roster-player-position">Guard</span><span class="height">6-1</span><span class="year">Sr.</span>'
                                    '<span class="sidearm-roster-player-hometown">Hometown: Erie, PA</span></li>'),
    )


@query(
    "h13_player_cards",
    """SELECT l_orderkey AS page_id, CASE WHEN l_linestatus = 'O' THEN '#9' ELSE 'Ana ' || l_suppkey END AS name, CAST(l_linenumber AS VARCHAR) AS jersey, 'G' AS position, '6-1' AS height,
      'Senior' AS academic_year, 'Erie, PA' AS hometown, '' AS high_school, '' AS previous_school, 'https://t.edu/roster/' || l_partkey AS url FROM lineitem WHERE l_returnflag <> 'N'""",
)
def h13(spark, d):
    return pages.player_cards(line_pages(spark, d, player_card_row(), '<ul class="sidearm-roster-players">', "</ul>"))


COACH_SQL = """SELECT DISTINCT l_orderkey AS page_id, CASE WHEN l_linestatus = 'O' THEN upper('Kay ' || l_suppkey) ELSE 'Kay ' || l_suppkey END AS name, l_suppkey FROM lineitem WHERE l_returnflag <> 'N'"""


def coach_card_row():
    name = F.concat(F.lit("Kay "), text("l_suppkey"))
    player = F.when(F.col("l_returnflag") == "N", "<p>Jersey Number 4</p>").otherwise("")
    return F.concat(
        F.lit('<div class="s-person-card"><h4>'), name, F.lit('</h4><a href="/coaches/'), text("l_suppkey"), F.lit('">bio</a>'), player,
        F.lit('<p class="title">'), F.when(F.col("l_linestatus") == "O", "Head Coach").otherwise("HEAD COACH"), F.lit('</p><i class="sidearm-roster-coach-seasons">5th</i></div>'),
    )


@query(
    "h13_coach_cards",
    """SELECT l_orderkey AS page_id, 'Kay ' || l_suppkey AS name, '5th' AS experience, '' AS alma_mater, 'https://t.edu/coaches/' || l_suppkey AS url
    FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey, l_suppkey""",
)
def h13_coaches(spark, d):
    return pages.coach_cards(line_pages(spark, d, coach_card_row())).drop("title")


@query(
    "h11_coach_as_roster",
    """SELECT l_orderkey AS page_id, 'Kay ' || l_suppkey AS name, 'head coach' AS position, '5th' AS academic_year, '' AS hometown, '' AS high_school, '' AS previous_school,
      '' AS height, '' AS jersey, 'https://t.edu/coaches/' || l_suppkey AS url, '2024-25' AS season FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey, l_suppkey""",
)
def h11(spark, d):
    coaches = pages.coach_cards(line_pages(spark, d, coach_card_row()))
    return pages.coach_as_roster(coaches, "page_id", F.lit("2024-25")).withColumn("position", F.lower("position"))


@query(
    "h15_indexed_people",
    """SELECT l_orderkey AS page_id, 'Ann Li' || l_suppkey AS name, CAST(l_linenumber AS VARCHAR) AS jersey, 'Guard' AS position, 'Senior' AS academic_year, '6''' || l_linenumber || '"' AS height,
      '' AS hometown, 'HS' || l_partkey AS high_school, '' AS previous_school FROM lineitem""",
)
def h15(spark, d):
    """Every line writes nine elements: one object and the eight values it points to."""
    at = F.col("i") * 9 + 1

    def ref(k):
        return (at + k).cast("string")

    item = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    listed = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page_id")).agg(item.alias("x"))
    rows = listed.select("page_id", F.posexplode("x").alias("i", "p")).select("page_id", "i", "p.*")
    keys = ["firstName", "lastName", "jerseyNumber", "positionLong", "academicYearLong", "highSchool", "hometown"]
    pairs = [F.concat(F.lit(f'"{k}": '), ref(n + 1)) for n, k in enumerate(keys)]
    pairs += [F.concat(F.lit('"heightFeet": '), ref(8)), F.concat(F.lit('"heightInches": '), ref(3)), F.lit('"positionShort": 0, "rosterPlayerId": 5')]
    values = F.concat(
        F.lit('"Ann", "Li'), text("l_suppkey"), F.lit('", '), text("l_linenumber"), F.lit(', "Guard", "Senior", "HS'), text("l_partkey"), F.lit('", 15, 6')
    )
    row = F.concat(F.lit("{"), F.array_join(F.array(*pairs), ", "), F.lit("}, "), values)
    made = rows.select("page_id", "i", row.alias("r")).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("i", "r"))).alias("rs"))
    html = F.concat(
        F.lit('<script type="application/json" id="__NUXT_DATA__">["", '), F.array_join(F.transform("rs", lambda s: s["r"]), ", "), F.lit("]</script>")
    )
    return pages.indexed_rows(made.select("page_id", html.alias("html")))


@query(
    "h16_labelled_cards",
    """SELECT l_orderkey AS page_id, 'Ana ' || l_suppkey AS name, CAST(l_linenumber AS VARCHAR) AS jersey, 'G' AS position, 'Junior' AS academic_year, '6-1' AS height, 'Erie, PA' AS hometown,
      'Cathedral ' || l_partkey AS high_school, 'https://t.edu/roster/' || l_partkey AS url FROM lineitem WHERE l_returnflag <> 'N'""",
)
def h16(spark, d):
    link = F.when(F.col("l_returnflag") == "N", "/roster/coaches/").otherwise("/roster/")
    row = F.concat(
        F.lit('<div class="x s-person-card"><a href="'), link, text("l_partkey"), F.lit('">Jersey Number '), text("l_linenumber"), F.lit("<b> Ana "), text("l_suppkey"),
        F.lit(" </b>Position G<i>Academic Year Jr.</i>Height 6-1Hometown Erie, PA Last School Cathedral "), text("l_partkey"), F.lit(" Full Bio</a></div>"),
    )
    return pages.labelled_cards(line_pages(spark, d, row))


@query(
    "h17_coach_table_rows",
    """SELECT l_orderkey AS page_id, 'Kay ' || l_suppkey AS name, CASE l_returnflag WHEN 'A' THEN 'Head Coach' ELSE 'Director of Ops' END AS title,
      CASE WHEN l_linestatus = 'O' THEN 'https://t.edu/c/' || l_partkey ELSE 'https://t.edu/sports/wbb/roster' END AS url FROM lineitem WHERE l_returnflag <> 'N'""",
)
def h17(spark, d):
    name = F.concat(F.lit("Kay "), text("l_suppkey"))
    cell = F.when(F.col("l_linestatus") == "O", F.concat(F.lit('<a href="/c/'), text("l_partkey"), F.lit('">'), name, F.lit("</a>"))).otherwise(name)
    title = F.when(F.col("l_returnflag") == "A", "Head Coach").when(F.col("l_returnflag") == "R", "Director of Ops").otherwise("Guard")
    row = F.concat(F.lit("<tr><td>"), cell, F.lit("</td><td>"), title, F.lit("</td></tr>"))
    head = "<table><tr><td>players</td><td>x</td></tr></table><h3 class=\"z\">Our Coaching Staff</h3><p>x</p><table><tr><th>Name</th><th>Title</th></tr>"
    return pages.coach_table_rows(line_pages(spark, d, row, head, "</table>"))


@query(
    "h17_coach_rows_in_main_table",
    """SELECT l_orderkey AS page_id, 'Kay ' || l_suppkey AS name, 'Assistant Coach' AS title, 'https://t.edu/sports/wbb/roster' AS url FROM lineitem WHERE l_returnflag = 'A'""",
)
def h17_main(spark, d):
    title = F.when(F.col("l_returnflag") == "A", "Assistant Coach").when(F.col("l_returnflag") == "R", "Coach on leave").otherwise("Guard")
    row = F.concat(F.lit("<tr><td>Kay "), text("l_suppkey"), F.lit("</td><td>"), title, F.lit("</td></tr>"))
    return pages.coach_table_rows(line_pages(spark, d, row, "<table><tr><th>Name</th><th>Title</th></tr>", "</table>"))


# The same rows inside elements that nest, with quotes of both kinds and entities.

NESTED_HEAD = (
    "<!-- <table><tr><th>no</th></tr></table> --><script>var t = '<table><tr><td>x</td></tr></table>';</script><TABLE class='r'><thead><tr><th>No.<th>Name</th><th>Pos.</th>"
    "<th>Hometown</th></tr></thead><tbody>"
)


@query(
    "h3_nested_tables",
    """SELECT l_orderkey AS page_id, CAST(l_linenumber AS VARCHAR) AS jersey, 'Zoë P' || chr(39) || l_suppkey || ' & co' AS name, l_returnflag AS position, '' AS height, '' AS academic_year,
      'Town' || l_partkey || ' (a > b)' AS hometown, '' AS high_school, '' AS previous_school, 'https://t.edu/roster/p/' || l_partkey || '?a=1&b=2' AS url FROM lineitem""",
)
def h3_nested(spark, d):
    row = F.concat(
        F.lit("<tr title='a > b'><td>"), text("l_linenumber"), F.lit("</td><td data-x=\"it's\"><a href='/roster/p/"), text("l_partkey"), F.lit("?a=1&amp;b=2'>Zo&euml; P&#39;"), text("l_suppkey"),
        F.lit(" &#x26; co</a><td>"), F.col("l_returnflag"), F.lit("</td><td>Town"), text("l_partkey"),
        F.lit("<table><tr><td> (a &gt; b)</td></tr></table></td></tr>"),
    )
    return pages.table_rows(line_pages(spark, d, row, NESTED_HEAD, "</tbody></TABLE><table><tr><td>other</td></tr></table>"))


@query(
    "h4_quoted_links",
    "SELECT page_id, 'A & ' || page_id AS text, 'https://stats.org/teams/' || page_id AS link, CAST(page_id AS VARCHAR) AS link_id FROM pages",
)
def h4_quoted(spark, d):
    n = F.col("page_id").cast("string")
    quotes = F.concat(pick("page_id", ["<a href='", "<A class=k HREF = '", '<a title="<a>" href=\'']), F.lit("https://stats.org/teams/"), n, F.lit("'><i>A</i> &amp; "), n, F.lit("</a>"))
    made = table(spark, d, "pages").select("page_id", "url", F.concat("html", quotes).alias("html"))
    return pages.page_links(made, r"/teams/\d+")


@query(
    "h9_nested_lists",
    """SELECT l_orderkey AS page_id, 'Jobs Open' AS status, 'School ' || l_suppkey AS school, '' AS conference, part AS coach, role, part || body AS text, CAST(NULL AS VARCHAR) AS date, url FROM
      (SELECT *, unnest([{'part': 'Coach ' || l_partkey, 'role': 'departed', 'body': ' resigned after Assistant ' || l_linenumber || ' left', 'url': 'https://a.edu/' || l_partkey},
        {'part': 'Assistant ' || l_linenumber, 'role': 'departed', 'body': ' left', 'url': 'https://b.edu/1'}], recursive := true) FROM lineitem)""",
)
def h9_nested(spark, d):
    row = F.concat(
        F.lit("<h2>Jobs Open</h2><h3>School "), text("l_suppkey"), F.lit("</h3><ul class='x'><li><strong>Coach "), text("l_partkey"), F.lit("</strong> resigned <a href='https://a.edu/"), text("l_partkey"),
        F.lit("'></a>after<ul><li><strong>Assistant "), text("l_linenumber"), F.lit("</strong> left<a href=https://b.edu/1></a></ul></ul>"),
    )
    return pages.sectioned_list(line_pages(spark, d, row), "blog.example.com")


@query(
    "h13_nested_cards",
    """SELECT l_orderkey AS page_id, 'Ana ' || l_suppkey AS name, CAST(l_linenumber AS VARCHAR) AS jersey, 'F' AS position, '6-1' AS height, '' AS academic_year, 'Erie, PA' AS hometown,
      'HS ' || l_partkey AS high_school, '' AS previous_school, 'https://t.edu/roster/' || l_partkey AS url FROM lineitem""",
)
def h13_nested(spark, d):
    row = F.concat(
        F.lit("<div class='player-card'><div><div class='name'><div><span>Ana</span></div><div> "), text("l_suppkey"), F.lit("</div></div></div><div class='a sidearm-roster-player-position'><div>"
              "<span class='text-bold'>Forward</span></div><div><div class='height'>6-1</div></div></div><a href='/roster/"), text("l_partkey"),
        F.lit("'><span class='sidearm-roster-player-jersey-number'><span><span class='sr-only'>Jersey <i>Number</i> </span>"), text("l_linenumber"),
        F.lit("</span></span></a><ul><li class='hometown'><ul><li>Erie,&nbsp;PA</li></ul></li><li class='high-school'><div><div>HS</div> "), text("l_partkey"), F.lit("</div></li></ul></div>"),
    )
    side = "<div class='player-card'><span class='name'>Not in the panel</span></div><div id='cardPanel'>"
    return pages.player_cards(line_pages(spark, d, row, side, "</div>"))


@query(
    "h13_coach_titles",
    """SELECT l_orderkey AS page_id, 'Kay ' || l_suppkey AS name, 'Coach ' || l_linenumber AS title, '' AS experience, 'State & Tech' AS alma_mater, 'https://t.edu/coaches/' || l_partkey AS url
    FROM lineitem WHERE l_returnflag <> 'N'""",
)
def h13_titles(spark, d):
    kind = F.when(F.col("l_returnflag") == "N", "<b class='sr-only'>Jersey Number</b>").otherwise("")
    row = F.concat(
        F.lit("<div class='s-person-card--list'><div class='s-person-details__personal-single-line'><div>Kay</div> <div>"), text("l_suppkey"), F.lit("</div></div>"), kind,
        F.lit("<p class='title'>Coach <b>"), text("l_linenumber"), F.lit("</b></p><p class='sidearm-roster-coach-college'>State &amp; Tech</p><a href='/coaches/"), text("l_partkey"), F.lit("'>x</a></div>"),
    )
    return pages.coach_cards(line_pages(spark, d, row))


@query(
    "h17_nested_coach_table",
    """SELECT l_orderkey AS page_id, 'Kay ' || l_suppkey AS name, 'Head Coach' || l_linenumber AS title, 'https://t.edu/c/' || l_partkey AS url FROM lineitem""",
)
def h17_nested(spark, d):
    row = F.concat(
        F.lit("<tr><td><div><a href='/c/"), text("l_partkey"), F.lit("'>Kay "), text("l_suppkey"), F.lit("</a></div></td><td><table><tr><td>Head Coach"), text("l_linenumber"), F.lit("</td></tr></table></td></tr>")
    )
    head = "<h2>Coaches of old</h2><table><tr><td>a</td></tr></table><h3><span>Our <b>Coaching</b> Staff</span></h3><table><tr><th>Name</th><th>Title</th></tr>"
    return pages.coach_table_rows(line_pages(spark, d, row, head, "</table>"))


@query(
    "w11_carried_values",
    """SELECT l_orderkey AS page_id, 'School ' || l_suppkey AS school, 'item ' || l_linenumber AS text, CASE l_returnflag WHEN 'A' THEN 'Jobs Open' ELSE 'Jobs Filled' END AS status
    FROM lineitem WHERE l_returnflag <> 'N'""",
)
def w11_values(spark, d):
    status = F.when(F.col("l_returnflag") == "N", "Other").when(F.col("l_returnflag") == "A", "Jobs open").otherwise("JOBS FILLED 2024")
    row = F.concat(F.lit("<h2>"), status, F.lit("</h2><h3>School "), text("l_suppkey"), F.lit("</h3><p>between</p><ul><li>item "), text("l_linenumber"), F.lit("</li></ul>"))
    return pages.sectioned_list(line_pages(spark, d, row), "b").select("page_id", "school", "text", "status")


def _plain_pages(spark, d):
    return table(spark, d, "pages").select("page_id", "url", "html")


@query(
    "h1_season_on_given_pages",
    """WITH t AS (SELECT page_id, unnest(list_concat(regexp_extract_all(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1>', 1), regexp_extract_all(html, '(?is)<h2(?:\s[^>]*)?>(.*?)</h2>', 1),
        regexp_extract_all(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title>', 1))) AS h FROM pages)
    SELECT pages.page_id, coalesce(bool_or(contains(h, '2024-25') OR contains(h, '2024 - 2025') OR contains(h, '2024-2025')), FALSE) AS shown FROM pages LEFT JOIN t USING (page_id) GROUP BY 1""",
)
def h1_given(spark, d):
    return _plain_pages(spark, d).select("page_id", pages.season_shown(F.col("html"), F.lit("2024-25"), F.lit(False)).alias("shown"))


@query(
    "h2_platform_of_given_pages",
    """SELECT page_id, regexp_matches(html, '(?is)class="[^"]*sidearm') AS is_sidearm FROM pages""",
)
def h2_given(spark, d):
    return _plain_pages(spark, d).select("page_id", pages.is_sidearm(F.col("html")).alias("is_sidearm"))


@query(
    "h5_game_id_on_given_pages",
    """SELECT page_id, nullif(regexp_extract(html, '/stats/match/(?:full/)?(\d+)', 1), '') AS match_id FROM pages""",
)
def h5_given(spark, d):
    return _plain_pages(spark, d).select("page_id", pages.match_id(F.col("html")).alias("match_id"))


@query(
    "h6_list_items_of_given_pages",
    f"""WITH li AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li>', 1)) AS t, generate_subscripts(regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li>', 1), 1) AS i FROM pages),
    v AS (SELECT page_id, i, {squish_sql(text_sql('t', ' '))} AS t FROM li)
    SELECT pages.page_id, coalesce(arg_min(regexp_replace(t, '^Home ?: *', ''), i) FILTER (regexp_matches(t, '^Home ?:')), '') AS home FROM pages LEFT JOIN v USING (page_id) GROUP BY 1""",
)
def h6_given(spark, d):
    return pages.list_fields(_plain_pages(spark, d), {"home": "Home"})


@query("h12_hidden_value_of_given_pages", "SELECT page_id, CAST(NULL AS VARCHAR) AS value FROM pages WHERE NOT contains(html, 'sit_stat_form_id')")
def h12_given(spark, d):
    return pages.hidden_value(_plain_pages(spark, d), "sit_stat_form_id", "stats_player_seq_field_id")
