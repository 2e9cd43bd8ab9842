"""Text functions, run over one text per row of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.functions import dates, roster, strings, titles, urls
from rimsight.operators import bios, careers
from rimsight.plans.registry import query
from rimsight.plans.sqltext import (
    case_sql, chain_sql, first_sql, ordered_sql, pick, pick_sql, quoted, squish_sql, strip_sql,
)
from rimsight.plans.standins import table

KEY = "o_orderkey"


def orders(spark, d):
    return table(spark, d, "orders")


def with_text(spark, d, values, suffix=None):
    """Orders with a text ``t`` picked by key, plus the row's own suffix."""
    text = pick(KEY, values)
    if isinstance(suffix, str):
        suffix = F.concat(F.lit(" "), F.col(suffix).cast("string"))
    if suffix is not None:
        text = F.concat(text, suffix)
    return orders(spark, d).select(KEY, "o_custkey", "o_orderdate", text.alias("t"))


def texts(values, suffix="''"):
    return f"x AS (SELECT o_orderkey, o_custkey, o_orderdate, {pick_sql(KEY, values)} || {suffix} AS t FROM orders)"


CUST = "o_custkey"
CUST_SQL = "' ' || o_custkey"

SCHOOL_NAMES = ["St. Mary's (CA)", "Texas A&M", "N.C. State, Raleigh", "Ohio St."]


@query(
    "f3_team_slug",
    f"""WITH {texts(SCHOOL_NAMES, CUST_SQL)} SELECT o_orderkey, o_custkey || '-' || translate(lower(t), ' .,''()', '-') AS slug FROM x""",
)
def f3(spark, d):
    x = with_text(spark, d, SCHOOL_NAMES, CUST)
    return x.select(KEY, strings.team_slug(F.col("o_custkey"), F.col("t")).alias("slug"))


ACCENTS = ["San José State", "Université Laval", "Müller & Söhne", "ÑANDÚ Tech", "plain 99", "Straße Æthel", "Þór œuvre"]


@query(
    "f4_join_key",
    f"""WITH {texts(ACCENTS, CUST_SQL)} SELECT o_orderkey, regexp_replace(lower(strip_accents(replace(replace(replace(replace(t, 'ß', 'ss'), 'Æ', 'AE'), 'Þ', 'TH'), 'œ', 'oe'))), '[^a-z0-9]', '', 'g') AS k,
      regexp_replace(lower(t), '[^a-z0-9]', '', 'g') AS k_plain FROM x""",
)
def f4(spark, d):
    x = with_text(spark, d, ACCENTS, CUST)
    return x.select(KEY, strings.join_key("t").alias("k"), strings.join_key("t", transliterate=False).alias("k_plain"))


CUPS = ["FIBA  Women's EuroBasket", "U19 World  Cup (Women)", "--Pre-Olympic -- Qualifiers--", "AmeriCup"]


@query(
    "f5_competition_slug",
    f"""WITH {texts(CUPS, CUST_SQL)} SELECT o_orderkey, """
    + chain_sql("lower(t)", [(r"\s+", "-"), (r"[^a-z0-9\-]", ""), ("-+", "-"), ("^-+|-+$", "")])
    + " || '-' || year(o_orderdate) AS slug FROM x",
)
def f5(spark, d):
    x = with_text(spark, d, CUPS, CUST)
    return x.select(KEY, strings.competition_slug(F.col("t"), F.year("o_orderdate")).alias("slug"))


@query(
    "f6_made_attempted",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS made,
      CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS attempted FROM lineitem""",
)
def f6(spark, d):
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")
    flag = F.col("l_returnflag")
    text = F.when(flag == "N", "n.a.").when(flag == "A", F.concat_ws("-", n, q)).otherwise(F.concat_ws("/", n, q))
    made, tried = strings.made_attempted(text)
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", made.alias("made"), tried.alias("attempted"))


CREWS = [" mary  ann o'brien,JOSÉ álvarez-ruiz", "dee   kantner, lisa MATTINGLY ", "d'arcy mc3rd", ""]
TITLE_SQL = """array_to_string(list_transform(regexp_extract_all({p}, '(\\p{{L}}+|[^\\p{{L}}]+)'),
  lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')"""


@query(
    "f7_name_list",
    f"""WITH {texts(CREWS, "' crew' || o_custkey")} SELECT o_orderkey, array_to_string(list_transform(string_split(t, ','),
      lambda p: {TITLE_SQL.format(p="replace(" + strip_sql("p") + ", '  ', ' ')")}), ';') AS names FROM x""",
)
def f7(spark, d):
    x = with_text(spark, d, CREWS, F.concat(F.lit(" crew"), F.col("o_custkey").cast("string")))
    return x.select(KEY, F.array_join(strings.name_list("t"), ";").alias("names"))


@query(
    "f8_percent",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE round(o_totalprice / 10000, 1) END AS pct FROM orders",
    "pct",
)
def f8(spark, d):
    shown = F.concat(F.round(F.col("o_totalprice") / 10000, 1).cast("string"), F.lit("%"))
    text = F.when(F.col("o_orderstatus") == "P", "n/a%").otherwise(shown)
    return orders(spark, d).select(KEY, strings.percent(text).alias("pct"))


CELLS = [
    "  Class:   Junior\t ", "Hometown / High School: Akron, OH", "Ht.: 6-1 Full Bio for", "No.: 12 Pos.: G", "HOMETOWN:  Erie, PA Instagram @x",
    "Harmony Sullivan Harmony Sullivan", "Hometown :", "Yr.: Cl.: Sr.", "High School/ Central", "Ann Lee Ann Lee Jones", "Opens in a new window x", "plain",
]


def labels_sql(expr):
    for p in roster.LABEL_PATTERNS:
        expr = strip_sql(f"regexp_replace({expr}, {quoted(p)}, '', 'gi')")
    return expr


def halves_sql(expr):
    return f"""(SELECT CASE WHEN len(w) >= 4 AND w[1:len(w) // 2] = w[len(w) // 2 + 1:len(w) // 2 * 2] THEN array_to_string(w[1:len(w) // 2], ' ') ELSE e END
      FROM (SELECT e, string_split_regex({strip_sql('e')}, '\\s+') AS w FROM (SELECT {expr} AS e)))"""


@query(
    "f9_clean_text",
    f"""WITH {texts(CELLS)}, y AS (SELECT o_orderkey, """
    + labels_sql("regexp_replace(" + squish_sql("t") + f", {quoted(roster.BIO_TAIL)}, '')")
    + f" AS e FROM x) SELECT o_orderkey, {halves_sql('y.e')} AS cleaned FROM y",
)
def f9(spark, d):
    return with_text(spark, d, CELLS).select(KEY, roster.clean(F.col("t")).alias("cleaned"))


@query(
    "f10_label_removal",
    f"""WITH {texts(CELLS, CUST_SQL)}, y AS (SELECT o_orderkey, {labels_sql('t')} AS e FROM x)
    SELECT o_orderkey, {halves_sql('y.e')} AS cleaned FROM y""",
)
def f10(spark, d):
    return with_text(spark, d, CELLS, CUST).select(KEY, roster.without_labels(F.col("t")).alias("cleaned"))


CARDS = ["Jersey Number 23 Ana", "#7 Guard 6'2\" Senior", "11 Bo PG/SG Height: 5-11, ok", "no data forward", "5′ 10″ Center #123", "F Height: 6 feet", "x 44 y"]


@query("f11_jersey", f"WITH {texts(CARDS, CUST_SQL)} SELECT o_orderkey, {first_sql('t', roster.JERSEY_PATTERNS)} AS jersey FROM x")
def f11(spark, d):
    return with_text(spark, d, CARDS, CUST).select(KEY, roster.jersey(F.col("t")).alias("jersey"))


@query(
    "f12_height",
    f"WITH {texts(CARDS, CUST_SQL)} SELECT o_orderkey, {strip_sql(first_sql('t', roster.HEIGHT_PATTERNS))} AS height FROM x",
)
def f12(spark, d):
    return with_text(spark, d, CARDS, CUST).select(KEY, roster.height(F.col("t")).alias("height"))


@query(
    "f13_position",
    f"""WITH {texts(CARDS, CUST_SQL)}, y AS (SELECT o_orderkey, t, regexp_extract(t, {quoted(roster.POSITION_PATTERN)}, 1) AS c FROM x)
    SELECT o_orderkey, CASE WHEN c <> '' THEN c WHEN contains(upper(t), 'GUARD') THEN 'G' WHEN contains(upper(t), 'FORWARD') THEN 'F'
      WHEN contains(upper(t), 'CENTER') THEN 'C' ELSE '' END AS position FROM y""",
)
def f13(spark, d):
    return with_text(spark, d, CARDS, CUST).select(KEY, roster.position(F.col("t")).alias("position"))


CLASSES = [f" {k} " for k in roster.CLASS_NAMES] + [" Fifth Year ", "Sr*"]


@query(
    "f14_class_name",
    f"WITH {texts(CLASSES)} SELECT o_orderkey, {case_sql(strip_sql('t'), roster.CLASS_NAMES, 't')} AS class FROM x",
)
def f14(spark, d):
    return with_text(spark, d, CLASSES).select(KEY, roster.class_name(F.col("t")).alias("class"))


RECODES = list(roster.CLASS_RECODE) + ["Fifth Year"]


@query(
    "f15_class_recode",
    f"WITH {texts(RECODES)} SELECT {case_sql('t', roster.CLASS_RECODE, 't')} AS class_clean, count(*) AS n FROM x GROUP BY 1",
)
def f15(spark, d):
    x = with_text(spark, d, RECODES)
    return x.groupBy(roster.recode_class(F.col("t"), F.col("t")).alias("class_clean")).agg(F.count(F.lit(1)).alias("n"))


PLACES = list(roster.POSITION_RECODE) + ["Wing"]


@query(
    "f16_position_recode",
    f"WITH {texts(PLACES)} SELECT {case_sql('t', roster.POSITION_RECODE, 't')} AS position_clean, count(*) AS n FROM x GROUP BY 1",
)
def f16(spark, d):
    x = with_text(spark, d, PLACES)
    return x.groupBy(roster.recode_position(F.col("t"), F.col("t")).alias("position_clean")).agg(F.count(F.lit(1)).alias("n"))


TOWNS = [
    "Akron, OH / Central HS / Kent State", "Erie, PA / Cathedral Prep", "Reno, Nev. Bishop Manogue", "Waco, TX Midway Baylor University",
    "Paris, France INSEP Tech Instagram x", "Lagos", "Ames, IA Ames HS Iowa State College", "Omaha, NE /  / Creighton", "a / b / c / d",
]
CITY = quoted(roster.CITY_STATE)


def _college_sql(kind):
    arms = []
    for w in roster.COLLEGE_WORDS:
        before = f"split_part(rest, '{w}', 1)"
        value = before if kind == "school" else f"substr(rest, length({before}) + 1)"
        arms.append(f"WHEN contains(rest, '{w}') THEN {strip_sql(value)}")
    return "CASE " + " ".join(arms) + (f" ELSE {strip_sql('rest')} END" if kind == "school" else " ELSE '' END")


@query(
    "f17_hometown_and_school",
    f"""WITH {texts(TOWNS)}, y AS (SELECT o_orderkey, {squish_sql(f"regexp_replace(t, {quoted(roster.SOCIAL_TAIL)}, '')")} AS t FROM x),
    z AS (SELECT *, string_split(t, ' / ') AS p, contains(t, ' / ') AS sl, regexp_matches(t, {CITY}) AS pl,
      regexp_extract(t, {CITY}, 1) AS city, regexp_extract(t, {CITY}, 2) AS st, regexp_extract(t, {CITY}, 3) AS rest FROM y)
    SELECT o_orderkey, CASE WHEN sl THEN {strip_sql('p[1]')} WHEN pl THEN {strip_sql('city')} || ', ' || {strip_sql('st')} ELSE t END AS hometown,
      CASE WHEN sl THEN coalesce({strip_sql('p[2]')}, '') WHEN pl THEN {_college_sql('school')} ELSE '' END AS high_school,
      CASE WHEN sl THEN coalesce({strip_sql('p[3]')}, '') WHEN pl THEN {_college_sql('previous')} ELSE '' END AS previous_school FROM z""",
)
def f17(spark, d):
    return with_text(spark, d, TOWNS).select(KEY, roster.town_parts(F.col("t")).alias("p")).select(KEY, "p.*")


HEADERS = list(roster.HEADER_FIELDS) + ["Twitter Handle", "GP"]


@query(
    "f18_header_map",
    f"""WITH {texts(HEADERS)} SELECT {case_sql('t', roster.HEADER_FIELDS, "replace(lower(t), ' ', '_')")} AS field, count(*) AS n FROM x GROUP BY 1""",
)
def f18(spark, d):
    return with_text(spark, d, HEADERS).groupBy(roster.header_field(F.col("t")).alias("field")).agg(F.count(F.lit(1)).alias("n"))


HOMES = ["Akron", "Erie, PA", "", "Reno"]


@query(
    "f19_state_to_hometown",
    f"""WITH {texts(HOMES)} SELECT o_orderkey, CASE WHEN c_acctbal > 2000 AND t <> '' AND NOT contains(t, ',') THEN t || ', ST' || c_nationkey ELSE t END AS hometown
    FROM x JOIN customer ON o_custkey = c_custkey""",
)
def f19(spark, d):
    cust = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.concat(F.lit("ST"), F.col("c_nationkey").cast("string")).alias("st"))
    x = with_text(spark, d, HOMES).join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return x.select(KEY, roster.town_with_state(F.col("t"), F.col("c_acctbal") > 2000, F.col("st")).alias("hometown"))


def season_text():
    y = F.year("o_orderdate")
    good = F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))
    late = F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 2) % 100).cast("string"), 2, "0"))
    status = F.col("o_orderstatus")
    return F.when(status == "F", good).when(status == "O", late).when(F.col("o_orderpriority") == "5-LOW", "").otherwise(y.cast("string"))


@query(
    "f20_season_validation",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'O' THEN 'not consecutive'
      WHEN o_orderpriority = '5-LOW' THEN 'empty' ELSE 'format' END AS problem FROM orders""",
)
def f20(spark, d):
    return orders(spark, d).select(KEY, dates.season_problem(season_text()).alias("problem"))


@query(
    "f21_season_spellings",
    """SELECT o_orderkey, year(o_orderdate) || '-' || e || '|' || year(o_orderdate) || ' - ' || c || e || '|' || year(o_orderdate) || '-' || c || e
      || CASE WHEN o_orderpriority = '5-LOW' THEN '|' || year(o_orderdate) ELSE '' END AS spellings
    FROM (SELECT *, lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS e, substr(CAST(year(o_orderdate) AS VARCHAR), 1, 2) AS c FROM orders)""",
)
def f21(spark, d):
    y = F.year("o_orderdate")
    season = F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))
    listed = dates.season_spellings(season, F.col("o_orderpriority") == "5-LOW")
    return orders(spark, d).select(KEY, F.array_join(listed, "|").alias("spellings"))


BASES = [
    "https://a.edu/sports/wbb/", "https://arkansasrazorbacks.com/x", "https://goaztecs.com/y", "https://miamihurricanes.com/sports/wbball",
    "https://hawkeyesports.com/sports/wbball", "https://hawkeyesports.com", "https://gomason.com/wbb", "https://hawaiiathletics.com/wbb//",
    "https://b.edu/2024-25", "https://c.edu/wbb",
]
NAMED = list(urls.FORMATS) + ["direct_url", "unknown"]
PATH = "CASE WHEN entity = 'coach' THEN 'coaches' ELSE 'roster' END"


def _format_sql(template):
    text = quoted(template)
    for key, value in (("{p}", "p"), ("{s}", "'2024-25'"), ("{y}", "'2024'"), ("{f}", "'2024-2025'"), ("{n}", "'2025-26'")):
        text = f"replace({text}, '{key}', {value})"
    return text


@query(
    "f22_roster_url",
    f"""WITH u AS (SELECT o_orderkey, {pick_sql(KEY, BASES)} AS base, {pick_sql('o_custkey', NAMED)} AS fmt,
      CASE WHEN o_orderstatus = 'F' THEN 'coach' ELSE 'player' END AS entity FROM orders),
    v AS (SELECT *, regexp_replace(base, '/+$', '') AS root, {PATH} AS p FROM u)
    SELECT o_orderkey, CASE WHEN contains(base, '/2024-25') OR fmt = 'direct_url' THEN base || '/2024-25'
      WHEN starts_with(root, 'https://arkansasrazorbacks.com') THEN 'https://arkansasrazorbacks.com/sport/w-baskbl/' || p || '/?season=2024-25'
      WHEN starts_with(root, 'https://goaztecs.com') THEN 'https://goaztecs.com/sports/womens-basketball/' || p || '/season/2024-25?view=table'
      WHEN starts_with(root, 'https://miamihurricanes.com') THEN root || '/roster/season/2024-25/'
      WHEN starts_with(root, 'https://hawkeyesports.com') THEN root || CASE WHEN entity = 'coach' THEN '/roster/season/2024-25?tab=coaches'
        WHEN contains(root, '/wbball') THEN '/roster/season/2024-25?view=table' ELSE '/sports/wbball/roster/season/2024-25?view=table' END
      WHEN starts_with(root, 'https://gomason.com') OR starts_with(root, 'https://miamiredhawks.com') THEN root || '/roster/2024-25'
      WHEN starts_with(root, 'https://hawaiiathletics.com') THEN root || '/' || p || '/2024-2025'
      ELSE root || CASE fmt {' '.join(f"WHEN '{k}' THEN {_format_sql(t)}" for k, t in urls.FORMATS.items())} ELSE '/' || p || '/2024-25' END END AS url FROM v""",
)
def f22(spark, d):
    entity = F.when(F.col("o_orderstatus") == "F", "coach").otherwise("player")
    url = urls.roster_url(pick(KEY, BASES), F.lit("2024-25"), pick("o_custkey", NAMED), entity)
    return orders(spark, d).select(KEY, url.alias("url"))


@query(
    "f23_host_and_absolute",
    """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, CASE WHEN page_id % 4 = 0 THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/roster/' || page_id
      WHEN page_id % 4 = 1 THEN 'https://x.edu/' || page_id WHEN page_id % 4 = 2 THEN '' ELSE
      regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^:/])/[^/]*$', '\\1/') || 'p' || page_id END AS link FROM pages""",
)
def f23(spark, d):
    n = F.col("page_id")
    text = n.cast("string")
    link = (
        F.when(n % 4 == 0, F.concat(F.lit("/roster/"), text))
        .when(n % 4 == 1, F.concat(F.lit("https://x.edu/"), text))
        .when(n % 4 == 2, "")
        .otherwise(F.concat(F.lit("p"), text))
    )
    return table(spark, d, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.absolute(F.col("url"), link).alias("link"))


EVENTS = ["/data/afrobasket_2019_players_game_stats.csv", "olympics_2020_players_game_stats.csv", "x/worldcup_2018_a.csv", "bad.csv"]


@query(
    "f24_event_and_year",
    f"""WITH {texts(EVENTS)} SELECT o_orderkey, regexp_extract(t, '([^/_]+)_(\\d{{4}})_', 1) AS event, regexp_extract(t, '([^/_]+)_(\\d{{4}})_', 2) AS year FROM x""",
)
def f24(spark, d):
    event, year = urls.event_and_year(F.col("t"))
    return with_text(spark, d, EVENTS).select(KEY, event.alias("event"), year.alias("year"))


COUNTRIES = list(bios.COUNTRY_NAMES) + ["Japan", "China", "Mali"]


@query(
    "f25_country_names",
    f"WITH {texts(COUNTRIES)} SELECT o_orderkey, {case_sql('t', bios.COUNTRY_NAMES, 't')} AS country FROM x",
)
def f25(spark, d):
    return with_text(spark, d, COUNTRIES).select(KEY, strings.map_values(F.col("t"), bios.COUNTRY_NAMES).alias("country"))


POSTS = [
    "Jane Doe hired as head coach on March 5, 2024 .", "Kim Lee was NAMED coach Sept. 12, 2023", "Al Roe renamed the arena, Feb 3, 2022",
    "Resigned Dec. 31, 2021 )", "no date here", "May 4, 2020: fired", "Unhired on Foo 1, 2020",
]
MONTH_RE = quoted(dates.MONTH_DATE)
MONTH_ARMS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in dates.MONTHS.items())


@query(
    "f27_role_of_post",
    f"""WITH {texts(POSTS, CUST_SQL)} SELECT o_orderkey, CASE WHEN regexp_matches(t, '(?i)\\b(hired|named)\\b') THEN 'hired' ELSE 'departed' END AS role FROM x""",
)
def f27(spark, d):
    return with_text(spark, d, POSTS, CUST).select(KEY, titles.role_of_post(F.col("t")).alias("role"))


HEADINGS = ["  Ohio State (Big Ten) ", "Miami (FL) (ACC)", "Army", "X ( Y )  ", "St. John's (Big East)"]


@query(
    "f28_school_and_conference",
    f"""WITH {texts(HEADINGS)}, y AS (SELECT o_orderkey, {strip_sql('t')} AS t FROM x)
    SELECT o_orderkey, CASE WHEN regexp_matches(t, '^(.+?)\\s*\\(([^)]+)\\)\\s*$') THEN {strip_sql("regexp_extract(t, '^(.+?)\\s*\\(([^)]+)\\)\\s*$', 1)")} ELSE t END AS school,
      {strip_sql("regexp_extract(t, '^(.+?)\\s*\\(([^)]+)\\)\\s*$', 2)")} AS conference FROM y""",
)
def f28(spark, d):
    school, conference = titles.school_and_conference(F.col("t"))
    return with_text(spark, d, HEADINGS).select(KEY, school.alias("school"), conference.alias("conference"))


LINKS = [
    '<a href="https://blog.example.com/1">x</a> <a class="k" href="https://a.edu/pr', '<a href="https://b.edu/', '<a href="https://blog.example.com/2',
    '<p>none',
]


@query(
    "f29_external_link",
    f"""WITH {texts(LINKS, "o_custkey || " + quoted('">y</a>'))} SELECT o_orderkey,
      list_filter(regexp_extract_all(t, '<a\\s[^>]*href="([^"]*)"', 1), lambda u: NOT contains(u, 'blog.example.com'))[1] AS link FROM x""",
)
def f29(spark, d):
    x = with_text(spark, d, LINKS, F.concat(F.col("o_custkey").cast("string"), F.lit('">y</a>')))
    return x.select(KEY, titles.external_link(F.col("t"), "blog.example.com").alias("link"))


BRACES = ["entered portal ", "Entered  Portal ", "ENTERED PORTAL "]


@query(
    "f30_portal_date",
    f"""WITH {texts(BRACES, "strftime(o_orderdate, '%-m/%-d/') || (o_custkey % 90 + 10) || '; x'")}
    SELECT o_orderkey, CASE WHEN t ILIKE 'entered portal %' THEN CAST(2000 + o_custkey % 90 + 10 AS VARCHAR) || strftime(o_orderdate, '-%m-%d') END AS day FROM x""",
)
def f30(spark, d):
    suffix = F.concat(F.date_format("o_orderdate", "M/d/"), (F.col("o_custkey") % 90 + 10).cast("string"), F.lit("; x"))
    return with_text(spark, d, BRACES, suffix).select(KEY, dates.portal_date(F.col("t")).alias("day"))


HISTORIES = ["entered portal 4/1/25; Transfer History : A  to\n B", "transfer history:C to D", "none"]


@query(
    "f31_transfer_history",
    f"""WITH {texts(HISTORIES, CUST_SQL)} SELECT o_orderkey, CASE WHEN regexp_matches(t, '(?is)transfer history\\s*:\\s*(.+)')
      THEN {squish_sql("regexp_extract(t, '(?is)transfer history\\s*:\\s*(.+)', 1)")} END AS history FROM x""",
)
def f31(spark, d):
    return with_text(spark, d, HISTORIES, CUST).select(KEY, titles.transfer_history(F.col("t")).alias("history"))


def transfer_lines(spark, d):
    name = F.concat(F.lit("Player "), F.col("o_custkey").cast("string"))
    arrow = F.when(F.col("o_orderstatus") == "F", " → Ohio St.").otherwise("")
    school = F.when(F.col("o_orderstatus") == "O", " / Old State").otherwise("")
    grad = F.when(F.col("o_orderpriority") == "5-LOW", " (grad xfer)").otherwise("")
    body = F.when(F.col("o_orderpriority") == "1-URGENT", ", details to come").otherwise(
        F.concat(F.lit(", 6-"), (F.col(KEY) % 10).cast("string"), pick(KEY, [" RS  SO", " jr", " GR"]), pick("o_custkey", [" G", " F/C "]),
                 F.lit(", Town"), (F.col(KEY) % 100).cast("string"), F.lit(", OH"), grad, school, arrow)
    )
    brace = F.when(F.col("o_totalprice") > 200000, F.concat(F.lit(" {entered portal "), F.date_format("o_orderdate", "M/d/yy"),
                                                            F.lit("; transfer history: A to  B}"))).otherwise("")
    return orders(spark, d).select(KEY, F.concat(F.lit("• "), name, F.lit(", x")).alias("bold"), F.concat(F.lit(" • "), name, body, brace).alias("line"))


@query(
    "f32_player_line",
    f"""SELECT o_orderkey, 'Player ' || o_custkey AS name, CASE WHEN ok THEN '6-' || o_orderkey % 10 END AS height,
      CASE WHEN ok THEN {pick_sql(KEY, ['RS SO', 'jr', 'GR'])} END AS year, CASE WHEN ok THEN {pick_sql('o_custkey', ['G', 'F/C'])} END AS position,
      CASE WHEN ok THEN CASE WHEN o_custkey % 2 = 1 THEN ', ' ELSE '' END || 'Town' || o_orderkey % 100 || ', OH' || CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN ' (grad xfer)' ELSE '' END END AS hometown,
      CASE WHEN o_totalprice > 200000 THEN '20' || strftime(o_orderdate, '%y-%m-%d') END AS entered_portal,
      CASE WHEN o_totalprice > 200000 THEN 'A to B' END AS transfer_history
    FROM (SELECT *, o_orderpriority <> '1-URGENT' AS ok FROM orders)""",
)
def f32(spark, d):
    x = transfer_lines(spark, d).select(KEY, roster.player_line(F.col("bold"), F.col("line")).alias("p"))
    return x.select(KEY, "p.*")


@query(
    "f33_us_date",
    "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day FROM lineitem",
)
def f33(spark, d):
    text = F.when(F.col("l_returnflag") == "N", "").otherwise(F.date_format("l_shipdate", "M/d/yyyy"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", dates.us_date(text).alias("day"))


@query(
    "f34_day_month_year",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
)
def f34(spark, d):
    text = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.date_format("o_orderdate", "d MMM yyyy"))
    return orders(spark, d).select(KEY, dates.day_month_year(text).alias("day"))


@query(
    "f35_month_name_date",
    f"""WITH {texts(POSTS, CUST_SQL)}, y AS (SELECT o_orderkey, regexp_extract(t, {MONTH_RE}, ['m', 'd', 'y']) AS p FROM x)
    SELECT o_orderkey, CASE WHEN p.m <> '' THEN p.y || '-' || lpad(CAST(CASE lower(p.m) {MONTH_ARMS} END AS VARCHAR), 2, '0') || '-' || lpad(p.d, 2, '0') END AS day FROM y""",
)
def f35(spark, d):
    return with_text(spark, d, POSTS, CUST).select(KEY, dates.month_name_date(F.col("t")).alias("day"))


@query(
    "f36_event_date",
    """SELECT o_orderkey, CASE WHEN make_date(2021, month(o_orderdate), least(day(o_orderdate), 28)) > DATE '2021-08-30' THEN '2020' ELSE '2021' END
      || strftime(make_date(2021, month(o_orderdate), least(day(o_orderdate), 28)), '-%m-%d') AS day FROM orders""",
)
def f36(spark, d):
    day = F.least(F.dayofmonth("o_orderdate"), F.lit(28))
    text = F.concat(day.cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"))
    return orders(spark, d).select(KEY, dates.event_date(text, F.lit(2021)).alias("day"))


@query(
    "f37_clock_seconds",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_linenumber * 60 + CAST(l_quantity AS BIGINT) END AS seconds FROM lineitem""",
)
def f37(spark, d):
    clock = F.format_string("%02d:%02d", "l_linenumber", F.col("l_quantity").cast("int"))
    flag = F.col("l_returnflag")
    text = F.when(flag == "N", "").when(flag == "A", F.concat(clock, F.lit(":00"))).otherwise(clock)
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", strings.clock_seconds(text).alias("seconds"))


@query(
    "f38_month_windows",
    """SELECT o_orderkey, strftime(m, '%Y-%m-%d') AS month_start FROM (SELECT o_orderkey, unnest(generate_series(date_trunc('month', o_orderdate),
      date_trunc('month', o_orderdate + INTERVAL 70 DAY), INTERVAL 1 MONTH)) AS m FROM orders)""",
)
def f38(spark, d):
    first = F.col("o_orderdate").cast("date")
    return orders(spark, d).select(KEY, F.explode(dates.month_starts(first, F.date_add(first, 70))).alias("month_start"))


@query(
    "f38_daily_series",
    """SELECT o_orderpriority, strftime(m, '%Y-%m-%d') AS day, count(*) AS n FROM (SELECT o_orderpriority, unnest(generate_series(o_orderdate, o_orderdate + INTERVAL 3 DAY,
      INTERVAL 1 DAY)) AS m FROM orders) GROUP BY 1, 2""",
)
def f38_days(spark, d):
    first = F.col("o_orderdate").cast("date")
    each = orders(spark, d).select("o_orderpriority", F.explode(dates.days(first, F.date_add(first, 3))).alias("day"))
    return each.groupBy("o_orderpriority", "day").agg(F.count(F.lit(1)).alias("n"))


JOBS = [
    "Head Coach", "HEAD COACH/Recruiting Coordinator", "Acting Head Coach", "The Pat Summitt Head Coach", "Associate Head Coach", "Asst. Coach", "Lead Assistant & Scout",
    "Women's Basketball Graduate Manager", "Assistant Coach, Women's Basketball", "Director of Basketball Operations", "Video Coordinator and Player Development",
    "Team Manager", "manager", "Administrative Assistant", "Strength and Conditioning", "Interim Head Coach", "Trainer, Athletic Trainer", "Scout",
    "Volunteer Assistant", "Old Women's Basketball Aide", "Assistant to the Head",
]


@query(
    "f39_separator_and_sport_flags",
    f"""WITH {texts(JOBS)} SELECT o_orderkey, contains(t, '/') AS has_slash, contains(t, '&') AS has_ampersand, contains(t, ' and ') AS has_and, contains(t, ',') AS has_comma,
      starts_with(t, 'Women''s Basketball') AS prefix, ends_with(t, 'Women''s Basketball') AS suffix,
      contains(t, 'Women''s Basketball') AND NOT starts_with(t, 'Women''s Basketball') AND NOT ends_with(t, 'Women''s Basketball') AS inline FROM x""",
)
def f39(spark, d):
    flags = {**titles.separator_flags(F.col("t")), **titles.sport_flags(F.col("t"))}
    return with_text(spark, d, JOBS).select(KEY, *[c.alias(n) for n, c in flags.items()])


TITLE_SQL_STD = ordered_sql(chain_sql("lower(t)", titles.TITLE_CLEANING), titles.TITLE_PATTERNS, "'Other'")


@query("f40_standard_title", f"WITH {texts(JOBS)} SELECT o_orderkey, t AS title, {TITLE_SQL_STD} AS standard FROM x")
def f40(spark, d):
    return with_text(spark, d, JOBS).select(KEY, F.col("t").alias("title"), titles.standard_title(F.col("t")).alias("standard"))


@query(
    "a34_unmapped_titles",
    f"""WITH {texts(JOBS)}, y AS (SELECT t AS title, {TITLE_SQL_STD} AS standard FROM x)
    SELECT title, count(*) AS n FROM y WHERE standard IS NULL OR standard = 'Other' GROUP BY 1""",
)
def a34_titles(spark, d):
    rows = with_text(spark, d, JOBS).select(F.col("t").alias("title"), titles.standard_title(F.col("t")).alias("standard"))
    return careers.unmapped_titles(rows, "title", "standard")


ENTRIES = ["NON_NCAA", "Lincoln High School", "AAU Comets", "Professional (overseas)", "Ohio State", "High Point"]


@query(
    "a34_flagged_schools",
    f"""WITH {texts(ENTRIES)} SELECT t AS school, count(*) AS n FROM x
    WHERE regexp_matches(t, 'NON_NCAA|AAU|High School|Professional') GROUP BY 1""",
)
def a34_schools(spark, d):
    return careers.flagged_schools(with_text(spark, d, ENTRIES).select(F.col("t").alias("school")), "school")


@query(
    "f41_role_components",
    f"""WITH {texts(JOBS)}, y AS (SELECT o_orderkey, unnest(list_filter(list_transform(string_split_regex(t, {quoted(titles.ROLE_SEPARATOR)}), lambda r: {strip_sql('r')}),
      lambda r: r <> '')) AS t FROM x) SELECT o_orderkey, t AS role, {TITLE_SQL_STD} AS standard FROM y""",
)
def f41(spark, d):
    x = with_text(spark, d, JOBS).select(KEY, F.explode(titles.role_components(F.col("t"))).alias("role"))
    return x.select(KEY, "role", titles.standard_title(F.col("role")).alias("standard"))


SCHOOLS = [
    "LSU", "Texas A & M", "texas a&m-commerce", "UConn", "St. Joseph's", "Iowa", "Northern Iowa", "Connecticut STORM AAU", "Reno High School", "WNBA", "Phoenix Mercury",
    "Cal State  Fullerton", "Alabama-Huntsville", "  Odd   Place ", "Louisiana State", "Elite Academy", "Mount St. Mary's",
]


@query(
    "j13_first_match_school",
    f"""WITH {texts(SCHOOLS)} SELECT o_orderkey, t AS college, {ordered_sql('t', titles.SCHOOL_PATTERNS, strip_sql("regexp_replace(t, ' +', ' ', 'g')"), '(?i)')} AS standard FROM x""",
)
def j13(spark, d):
    return with_text(spark, d, SCHOOLS).select(KEY, F.col("t").alias("college"), titles.standard_school(F.col("t")).alias("standard"))


@query(
    "p16_variation_finder",
    f"""WITH {texts(SCHOOLS)} SELECT t AS college, count(*) AS n FROM x WHERE regexp_matches(t, '(?i)^iowa|connecticut|uconn|texas.*a.*m') GROUP BY 1""",
)
def p16(spark, d):
    hit = F.col("t").rlike("(?i)^iowa|connecticut|uconn|texas.*a.*m")
    return with_text(spark, d, SCHOOLS).where(hit).groupBy(F.col("t").alias("college")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p17_non_ncaa_flag",
    f"WITH {texts(SCHOOLS)} SELECT o_orderkey, regexp_matches(t, {quoted('|'.join(titles.NON_NCAA))}) AS non_ncaa FROM x",
)
def p17(spark, d):
    return with_text(spark, d, SCHOOLS).select(KEY, titles.non_ncaa(F.col("t")).alias("non_ncaa"))


@query(
    "p18_abbreviations_present",
    f"""WITH {texts(SCHOOLS)} SELECT t AS college, t IN ({', '.join(quoted(a) for a in titles.ABBREVIATIONS)}) AS abbreviation,
      regexp_matches(t, {quoted('|'.join(titles.FULL_NAMES))}) AS full_name, count(*) AS n FROM x GROUP BY 1, 2, 3 HAVING abbreviation OR full_name""",
)
def p18(spark, d):
    x = with_text(spark, d, SCHOOLS).groupBy(F.col("t").alias("college")).agg(F.count(F.lit(1)).alias("n"))
    x = x.withColumn("abbreviation", F.col("college").isin(*titles.ABBREVIATIONS))
    return x.withColumn("full_name", F.col("college").rlike("|".join(titles.FULL_NAMES))).where("abbreviation OR full_name")


@query(
    "f45_nested_default",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS plain,
      CASE WHEN o_orderstatus = 'F' OR o_custkey = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS truthy FROM orders""",
)
def f45(spark, d):
    nested = F.when(F.col("o_orderstatus") != "F", F.struct(F.struct(F.col("o_custkey").alias("teamId")).alias("inner")))
    x = orders(spark, d).select(KEY, nested.alias("teamA"))
    return x.select(KEY, strings.or_blank("teamA.inner.teamId").alias("plain"), strings.falsy_blank("teamA.inner.teamId").alias("truthy"))


REPLIES = [
    'Sure:\n```json\n{"positions": [{"college": "A", "title": "Coach"}], "education": []}\n``` done ', '{"positions": []} ', "no json ",
    '{"positions": [{"college": "B"}, {"college": "C"}], "education": [{"college": "D"}], "playing_career": [{"team": "E"}]} tail ',
]


@query(
    "f46_json_in_noise",
    f"""WITH {texts(REPLIES, CUST_SQL)}, y AS (SELECT o_orderkey, TRY_CAST(regexp_extract(t, '(?s)\\{{.*\\}}') AS JSON) AS j FROM x),
    z AS (SELECT o_orderkey, j, json_extract(j, '$.positions') IS NOT NULL AND json_extract(j, '$.education') IS NOT NULL AS ok FROM y)
    SELECT o_orderkey, CASE WHEN ok THEN CAST(json_array_length(j, '$.positions') AS BIGINT) ELSE 0 END AS positions,
      CASE WHEN ok THEN CAST(json_array_length(j, '$.education') AS BIGINT) ELSE 0 END AS education,
      CASE WHEN ok THEN coalesce(CAST(json_array_length(j, '$.playing_career') AS BIGINT), 0) ELSE 0 END AS playing FROM z""",
)
def f46(spark, d):
    x = with_text(spark, d, REPLIES, CUST).select(KEY, bios.career_json(F.col("t")).alias("c"))
    return x.select(KEY, F.size("c.positions").alias("positions"), F.size("c.education").alias("education"), F.size("c.playing_career").alias("playing"))


@query(
    "f49_game_file_id",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS file_id FROM orders",
)
def f49(spark, d):
    raw = F.concat(F.col("o_custkey").cast("string"), pick(KEY, ["&path=wbball", "", "&a&b"]))
    return orders(spark, d).select(KEY, strings.game_file_id(raw).alias("file_id"))


SLUGS = ["/europe/eurobasket-women/2023/games", "/world/womens-cup/2022", "/asia/womens-cup/2021/teams", "/world/men/2020", "/americas/U16-Women/2019"]


@query(
    "f50_event_identity",
    f"""WITH {texts(SLUGS)}, y AS (SELECT CASE WHEN contains(lower(t), 'women') AND NOT contains(t, '/games') AND regexp_matches(t, '/([^/]+/[^/]*women[^/]*/\\d{{4}})')
      THEN '/' || regexp_extract(t, '/([^/]+/[^/]*women[^/]*/\\d{{4}})', 1) END AS slug FROM x)
    SELECT slug, regexp_extract(slug, '/(\\d{{4}})', 1) AS year, count(*) AS n FROM y WHERE contains(lower(slug), 'cup') GROUP BY 1, 2""",
)
def f50(spark, d):
    x = with_text(spark, d, SLUGS).select(urls.event_slug(F.col("t")).alias("slug")).where(F.lower("slug").contains("cup"))
    return x.groupBy("slug", F.regexp_extract("slug", r"/(\d{4})", 1).alias("year")).agg(F.count(F.lit(1)).alias("n"))


ARIA = ["Ana Li - Guard", "Bo Day jersey number 4 full bio", "Cy Fox full bio", "Dee image thumbnail", "  Eve "]


@query(
    "f51_name_from_label",
    f"""WITH {texts(ARIA, CUST_SQL)} SELECT o_orderkey, CASE WHEN contains(lower(t), 'image thumbnail') THEN '' WHEN contains(t, ' - ') THEN {strip_sql("split_part(t, ' - ', 1)")}
      ELSE {strip_sql("split_part(" + strip_sql("replace(t, ' full bio', '')") + ", ' jersey number ', 1)")} END AS name FROM x""",
)
def f51(spark, d):
    return with_text(spark, d, ARIA, CUST).select(KEY, roster.aria_name(F.col("t")).alias("name"))


@query(
    "f52_fill_if_empty",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'G' ELSE coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '') END AS position,
      CASE WHEN o_orderstatus = 'O' THEN '6-0' WHEN o_orderkey % 10 BETWEEN 4 AND 7 AND o_orderkey % 14 BETWEEN 0 AND 11 THEN (o_orderkey % 10) || '-' || (o_orderkey % 14) ELSE '' END AS height
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def f52(spark, d):
    cust = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("other"))
    x = orders(spark, d).join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    given = F.when(F.col("o_orderstatus") == "F", "G").otherwise("")
    tall = F.when(F.col("o_orderstatus") == "O", "6-0").otherwise("")
    built = roster.feet_inches((F.col(KEY) % 10).cast("string"), (F.col(KEY) % 14).cast("string"))
    return x.select(KEY, roster.fill(given, F.col("other")).alias("position"), roster.fill(tall, built).alias("height"))


WORDS = r"'[^\p{L}\p{M}\p{N}\p{Pc}]+'"


def count_sql(words):
    listed = ", ".join(quoted(w) for w in words)
    return f"len(list_filter(w, lambda v: v IN ({listed})))"


@query(
    "l1_pronoun_class",
    f"""WITH t AS (SELECT doc_id, string_split_regex(lower(text), {WORDS}) AS w FROM documents),
    c AS (SELECT doc_id, {count_sql(bios.PRONOUNS['F'])} AS f, {count_sql(bios.PRONOUNS['M'])} AS m, {count_sql(bios.PRONOUNS['N'])} AS n FROM t)
    SELECT doc_id, CASE WHEN f > m AND f > n THEN 'F' WHEN m > f AND m > n THEN 'M' WHEN n > f AND n > m THEN 'N' END AS label FROM c""",
)
def l1(spark, d):
    return table(spark, d, "documents").select("doc_id", bios.pronoun_class(F.col("text")).alias("label"))


@query(
    "l1_pronoun_class_conversations",
    f"""WITH t AS (SELECT role, string_split_regex(lower(text), {WORDS}) AS w FROM conversations),
    c AS (SELECT role, {count_sql(bios.PRONOUNS['F'])} AS f, {count_sql(bios.PRONOUNS['M'])} AS m, {count_sql(bios.PRONOUNS['N'])} AS n FROM t)
    SELECT role, coalesce(CASE WHEN f > m AND f > n THEN 'F' WHEN m > f AND m > n THEN 'M' WHEN n > f AND n > m THEN 'N' END, 'None') AS label, count(*) AS n
    FROM c GROUP BY 1, 2""",
)
def l1_conversations(spark, d):
    labelled = table(spark, d, "conversations").select("role", F.coalesce(bios.pronoun_class(F.col("text")), F.lit("None")).alias("label"))
    return labelled.groupBy("role", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "l2_career_facts",
    f"""WITH b AS (SELECT doc_id, text || chr(10) || 'She coached from ' || (1980 + doc_id % 30) || '-' || lpad(CAST((83 + doc_id) % 100 AS VARCHAR), 2, '0') ||
      ' and, since ' || (1990 + doc_id % 20) || ', holds a ' || {pick_sql('doc_id', bios.DEGREE_SAMPLES)} || '.' AS t FROM documents)
    SELECT doc_id, array_to_string(list_transform(regexp_extract_all(t, {quoted(bios.YEAR_RANGE)}), lambda r: substr(r, 1, 4) || '-' || substr(r, 6)), ';') AS ranges,
      array_to_string(regexp_extract_all(t, {quoted(bios.SINCE)}, 1), ';') AS since,
      concat_ws(';', {', '.join(f"CASE WHEN regexp_matches(t, {quoted(p)}) THEN {quoted(k)} END" for k, p in bios.DEGREES.items())}) AS degrees FROM b""",
)
def l2(spark, d):
    n = F.col("doc_id")
    tail = F.concat(
        F.lit("\nShe coached from "), (n % 30 + 1980).cast("string"), F.lit("-"), F.lpad(((n + 83) % 100).cast("string"), 2, "0"),
        F.lit(" and, since "), (n % 20 + 1990).cast("string"), F.lit(", holds a "), pick("doc_id", bios.DEGREE_SAMPLES), F.lit("."),
    )
    facts = table(spark, d, "documents").select("doc_id", bios.career_facts(F.concat("text", tail)).alias("f"))
    span = lambda r: F.concat_ws("-", r["start_text"], r["end_text"])
    return facts.select(
        "doc_id",
        F.array_join(F.transform("f.ranges", span), ";").alias("ranges"),
        F.array_join("f.since", ";").alias("since"),
        F.array_join("f.degrees", ";").alias("degrees"),
    )
