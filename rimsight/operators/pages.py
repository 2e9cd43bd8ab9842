"""Rows from stored roster, staff and news pages (page_id, url, html)."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimsight.functions import html as h
from rimsight.functions import markup as m
from rimsight.functions import roster, titles
from rimsight.functions.dates import month_name_date, season_spellings
from rimsight.functions.strings import let, squish, strip
from rimsight.functions.urls import absolute
from rimsight.operators.keyed import first_per_key

# fixed values: card and field classes of roster sites, in the order they are tried
PLAYER_CARDS = ["sidearm-roster-player", "sidearm-roster-list-item", "s-person-card", "player-card"]
COACH_CARDS = [
    "sidearm-roster-coach", "sidearm-roster-coaches-card", "sidearm-roster-staff-item", "s-person-card--list", "s-person-card",
]
PLAYER_FIELDS = {
    "jersey": ["sidearm-roster-player-jersey-number", "sidearm-roster-player-jersey"],
    "position": ["sidearm-roster-player-position", "position"],
    "height": ["sidearm-roster-player-height", "height"],
    "academic_year": ["sidearm-roster-player-academic-year", "sidearm-roster-player-academic-year-long", "year"],
    "hometown": ["sidearm-roster-player-hometown", "hometown"],
    "high_school": ["sidearm-roster-player-highschool", "sidearm-roster-player-high-school", "high-school"],
    "previous_school": ["sidearm-roster-player-previous-school"],
}
COACH_FIELDS = {
    "title": [
        "sidearm-roster-coach-title", "sidearm-roster-staff-title", "sidearm-roster-coach-position", "s-person-details__position", "title",
    ],
    "experience": ["sidearm-roster-coach-seasons", "sidearm-roster-coach-experience"],
    "alma_mater": ["sidearm-roster-coach-college", "sidearm-roster-coach-alma-mater"],
}
COACH_NAMES = ["sidearm-roster-coach-name", "sidearm-roster-staff-name", "s-person-details__personal-single-line"]
# fixed values: where cards are looked for first
PLAYER_PANELS, PLAYER_LIST = ["cardPanel", "listPanel", "tablePanel"], "sidearm-roster-players"
COACH_PANELS, COACH_LIST = ["coaching-staff", "roster-staff"], "sidearm-roster-coaches"
COACH_WORDS = ["coach", "director", "coordinator"]
COACH_ROWS = ["head coach", "assistant coach", "director", "coordinator"]


def _each(pages: DataFrame, rows: Column) -> DataFrame:
    """One row per struct of a costly array.

    A plain ``inline`` makes the optimizer test the array's size first and so
    compute it twice; the outer form does not, and empty arrays are dropped after.
    """
    out = pages.select("page_id", F.col("url").alias("_base"), F.inline_outer(rows))
    return out.where(F.col("link").isNotNull())


def season_shown(html: Column, season: Column, need_roster: Column, start_only: Column | None = None) -> Column:
    """Any heading with a spelling of the season and, for players, the word roster."""
    spellings = season_spellings(season, start_only)
    return F.exists(
        h.headings(html),
        lambda t: F.exists(spellings, lambda s: t.contains(s)) & (~need_roster | F.lower(t).contains("roster")),
    )


def is_sidearm(html: Column) -> Column:
    return (
        h.has_class(html, "li", "sidearm-roster-player")
        | h.has_class(html, "div", "sidearm-roster-list-item")
        | h.has_class(html, "span", "sidearm-roster-player-name")
        | html.rlike(r'(?is)<div\s[^>]*class="[^"]*sidearm')
    )


# fixed values: responsive classes of table cells
SHOWN_AGAIN = ["d-md-table-cell", "d-lg-table-cell", "d-xl-table-cell", "d-md-block", "d-lg-block", "d-xl-block"]
HIDDEN_WIDE = ["d-md-none", "d-lg-none", "d-xl-none"]


def _shows(classes: str) -> bool:
    """Whether a cell shows on a desktop."""
    names = set(classes.split())
    return not names.isdisjoint(SHOWN_AGAIN) if "d-none" in names else names.isdisjoint(HIDDEN_WIDE)


def _shape(page: m.Page, table: int) -> tuple[list[str], list[int]]:
    """Headers and body rows of one table; tables inside its cells are not its own."""
    cells, inner = page.once(("shape", table), lambda: _heads_and_rows(page, table))
    named = [t.strip() or "_empty_" for t in page.texts_of(cells)]
    return [n for n in named if n not in roster.UNWANTED_HEADERS], inner


def _heads_and_rows(page: m.Page, table: int) -> tuple[list[int], list[int]]:
    rows = page.rows(table)
    head, body = (page.first([k for k in page.tagged(tag, table) if page.scope[k] == table]) for tag in ("thead", "tbody"))
    if head is not None:
        nested = page.tagged("table", head)
        cells = [c for c in page.tagged("th", head) if not any(page.inside(c, t) for t in nested)]
    else:
        cells = page.cells(rows[0]) if rows else []
    return cells, rows[1:] if body is None else [r for r in rows if page.inside(r, body)]


_TABLE = "struct<headers:array<string>,rows:array<struct<cells:array<string>,link:string>>>"


def _first_table(page: m.Page) -> dict | None:
    table = page.first(page.tagged("table"))
    if table is None:
        return None
    headers, rows = _shape(page, table)
    out = []
    for row in rows:
        (cells, link), first = page.part(row, _shown)
        out.append({"cells": [page.said(c, first) for c in cells], "link": "" if link is None else page.attrs[row + link].get("href", "")})
    return {"headers": headers, "rows": out}


def _shown(page: m.Page, row: int) -> tuple[list, int | None]:
    """Where a row has the texts of its shown cells, and its first link."""
    cells = [c for c in page.cells(row) if _shows(page.attrs[c].get("class", ""))]
    return [page.places(c, row) for c in cells], _first_link(page, row)


def _first_link(page: m.Page, node: int) -> int | None:
    links = page.tagged("a", node)
    return links[0] - node if links else None


def table_rows(pages: DataFrame) -> DataFrame:
    """Player rows of the first table: hidden cells dropped, short rows skipped.

    Tables, rows and cells nest: a cell's text holds that of a table inside it, and that
    table's rows are no rows of the outer one. Quotes of both kinds and all entities are read.
    """
    found = m.parsed(pages, ["page_id", "url"], _TABLE, _first_table)
    rows = let(let(F.transform("found.headers", roster.header_field), _places), lambda at: _kept_rows(at, F.col("found.rows")))
    opened = _each(found, rows)
    split = F.col("_town.hometown") != ""
    previous = F.when(F.col("_town.previous_school") != "", F.col("_town.previous_school")).otherwise(F.col("previous_school"))
    return opened.select(
        "page_id",
        "jersey",
        "name",
        "position",
        "height",
        "academic_year",
        F.when(split, F.col("_town.hometown")).otherwise(F.col("hometown")).alias("hometown"),
        F.when(split, F.col("_town.high_school")).otherwise(F.col("high_school")).alias("high_school"),
        previous.alias("previous_school"),
        absolute(F.col("_base"), F.col("link")).alias("url"),
    )


_ROW_FIELDS = ["jersey", "name", "position", "height", "academic_year", "hometown", "high_school", "previous_school", "town"]


def _places(fields: Column) -> Column:
    """How many fields a table has and where each is, -1 if absent; the last of equal headers wins."""

    def place(name: str) -> Column:
        return F.when(F.array_contains(fields, name), (F.size(fields) - F.array_position(F.reverse(fields), name)).cast("int")).otherwise(-1)

    return F.struct(F.size(fields).alias("size"), *[place(n).alias(n) for n in _ROW_FIELDS])


def _kept_rows(at: Column, rows: Column) -> Column:
    """Long enough rows as structs of cleaned fields."""

    def read(row: Column) -> Column:
        def build(texts: Column) -> Column:
            def field(name: str) -> Column:
                return F.coalesce(F.when(at[name] >= 0, F.get(texts, at[name])), F.lit(""))

            names = ["jersey", "name", "position", "height", "hometown", "high_school", "previous_school"]
            return F.struct(
                *[field(n).alias(n) for n in names],
                roster.class_name(field("academic_year")).alias("academic_year"),
                roster.town_parts(field("town")).alias("_town"),
                row["link"].alias("link"),
            )

        return F.when(F.size(row["cells"]) >= at["size"], let(F.transform(row["cells"], roster.clean), build))

    return F.array_compact(F.transform(rows, read))


def page_links(pages: DataFrame, pattern: str) -> DataFrame:
    """Links matching a pattern: text, full address and numeric tail."""
    test = re.compile(pattern)

    def links(page: m.Page) -> list[dict]:
        named = [(page.attrs[a].get("href"), a) for a in page.tagged("a")]
        return [{"href": href, "text": page.text_of(a, everything=True).strip()} for href, a in named if href is not None and test.search(href)]

    found = m.parsed(pages, ["page_id", "url"], "array<struct<href:string,text:string>>", links)
    rows = found.select("page_id", "url", F.explode("found").alias("a"))
    return rows.select(
        "page_id",
        F.col("a.text").alias("text"),
        absolute(F.col("url"), F.col("a.href")).alias("link"),
        F.nullif(F.regexp_extract("a.href", r"/(\d+)$", 1), F.lit("")).alias("link_id"),
    )


def list_fields(pages: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Values of the first ``Label: value`` list items, one column for each name of ``labels``, '' if absent."""

    def value(items: Column, label: str) -> Column:
        hit = F.get(F.filter(items, lambda t: t.startswith(f"{label}:") | t.startswith(f"{label} :")), F.lit(0))
        return F.coalesce(strip(F.regexp_replace(hit, rf"{label} ?:", "")), F.lit(""))

    found = m.parsed(pages, ["page_id"], "array<string>", lambda page: [page.text_of(k, " ", everything=True) for k in page.tagged("li")])
    squeezed = found.select("page_id", F.transform("found", squish).alias("items"))
    return squeezed.select("page_id", *[value(F.col("items"), t).alias(n) for n, t in labels.items()])


def hidden_value(pages: DataFrame, form: str, field: str) -> DataFrame:
    """page_id and the value of an input inside a form, both found by element id; null if absent."""

    def read(page: m.Page) -> str | None:
        forms = [k for k in page.tagged("form") if page.attrs[k].get("id") == form]
        found = [k for k in page.tagged("input", forms[0]) if page.attrs[k].get("id") == field] if forms else []
        return page.attrs[found[0]].get("value") if found else None

    return m.parsed(pages, ["page_id"], "string", read).withColumnRenamed("found", "value")


def match_id(html: Column) -> Column:
    """Game id from a full-statistics link, else the first match path in the page."""
    anchor = F.regexp_extract(html, r'(?is)<a\s[^>]*href="[^"]*wmt\.games[^"]*/stats/match/full/(?:[^"]*/)?([^"/]+)"', 1)
    return F.coalesce(F.nullif(anchor, F.lit("")), F.nullif(F.regexp_extract(html, r"/stats/match/(?:full/)?(\d+)", 1), F.lit("")))


EMBEDDED_PERSON = (
    "first_name string, last_name string, rp_id string, height_feet string, height_inches string, academic_year_short string, "
    "hometown string, highschool string, previous_school string, position_short string, jersey_number string, title string"
)


def embedded_rows(pages: DataFrame, coaches: bool = False) -> DataFrame:
    """People in the roster object inside a script."""
    body = F.regexp_extract("html", r"(?s)roster:\s*(\{.*?\}),\s*roster_settings:", 1)
    part = "coaches" if coaches else "players"
    parsed = F.from_json(body, f"{part} array<struct<{EMBEDDED_PERSON.replace(' string', ':string')}>>")
    rows = pages.select("page_id", "url", F.explode(parsed[part]).alias("p"))
    blank = F.lit("")
    name = strip(F.concat_ws(" ", F.coalesce("p.first_name", blank), F.coalesce("p.last_name", blank)))
    slug = F.regexp_replace(F.regexp_replace(F.lower("name"), r"\s+", "-"), r"[^\w\-]+", "")
    folder = "/sports/womens-basketball/roster/coaches/" if coaches else "/sports/womens-basketball/roster/"
    tall = F.col("p.height_feet").isNotNull() & F.col("p.height_inches").isNotNull()
    rows = rows.withColumn("name", name)
    link = F.concat(F.lit(folder), slug, F.lit("/"), F.coalesce("p.rp_id", F.lit("None")))
    rest = [F.coalesce("p.title", blank).alias("position")] if coaches else [
        roster.class_name(F.coalesce("p.academic_year_short", blank)).alias("academic_year"),
        *[F.coalesce(f"p.{c}", blank).alias(o) for c, o in (("hometown", "hometown"), ("highschool", "high_school"), ("previous_school", "previous_school"))],
        F.when(tall, F.concat("p.height_feet", F.lit("'"), "p.height_inches", F.lit('"'))).otherwise("").alias("height"),
        F.coalesce("p.position_short", blank).alias("position"),
        F.coalesce("p.jersey_number", blank).alias("jersey"),
    ]
    return rows.select("page_id", F.col("p.rp_id").alias("player_id"), "name", *rest, absolute(F.col("url"), link).alias("url"))


def indexed_rows(pages: DataFrame) -> DataFrame:
    """People in a page state whose objects hold positions of other elements.

    Positions are resolved inside one expression over the state's array, so a page sends on
    its people, not a copy of its state for each object.
    """
    state = F.regexp_extract("html", r"""(?is)<script\s[^>]*id=["']?__NUXT_DATA__["']?[^>]*>(.*?)</script>""", 1)
    parsed = pages.select("page_id", F.from_json(state, "array<string>").alias("s"))
    names = {
        "first": "firstName", "last": "lastName", "jersey": "jerseyNumber", "short": "positionShort", "long": "positionLong", "year": "academicYearLong",
        "year_short": "academicYearShort", "feet": "heightFeet", "inches": "heightInches", "hometown": "hometown", "high_school": "highSchool", "previous_school": "previousSchool",
    }
    falsy = ["0", "", "null", "false"]

    def person(fields: Column) -> Column:
        def value(name: str) -> Column:
            def seen(raw: Column) -> Column:
                at = raw.try_cast("int")
                found = F.get("s", at)
                kept = F.when(found.isNull() | found.isin("", "15", "21"), "").otherwise(found)
                return F.coalesce(F.when(at < F.size("s"), kept).otherwise(raw), F.lit(""))

            return let(F.try_element_at(fields, F.lit(name)), seen)

        there = reduce(lambda x, y: x & y, [~F.coalesce(F.try_element_at(fields, F.lit(k)), F.lit("")).isin(*falsy) for k in ("firstName", "lastName", "rosterPlayerId")])
        return F.when(there, F.struct(*[value(k).alias(n) for n, k in names.items()]))

    objects = F.filter("s", lambda o: o.startswith("{"))
    people = F.array_compact(F.transform(objects, lambda o: let(F.from_json(o, "map<string,string>"), person)))
    rows = parsed.select("page_id", F.inline_outer(people)).where(F.col("first").isNotNull())

    def either(one: str, other: str) -> Column:
        return F.coalesce(F.nullif(F.col(one), F.lit("")), F.col(other))

    table = rows.select(
        "page_id",
        strip(F.concat_ws(" ", "first", "last")).alias("name"),
        "jersey",
        either("short", "long").alias("position"),
        either("year", "year_short").alias("academic_year"),
        F.when((F.col("feet") != "") & (F.col("inches") != ""), F.concat("feet", F.lit("'"), "inches", F.lit('"'))).otherwise("").alias("height"),
        "hometown",
        "high_school",
        "previous_school",
    )
    return table.where(F.length("name") > 2)


def labelled_cards(pages: DataFrame) -> DataFrame:
    """Players from the text between a card's labels; links to coaches and staff skipped."""

    def read(page: m.Page) -> list[dict]:
        return [{"link": page.href(c), "t": page.text_of(c, everything=True)} for c in page.classed("s-person-card")]

    found = m.parsed(pages, ["page_id", "url"], "array<struct<link:string,t:string>>", read)
    rows = found.select("page_id", "url", F.inline("found"))
    rows = rows.where(F.col("link").contains("/roster/") & ~F.col("link").contains("/coaches/") & ~F.col("link").contains("/staff/"))

    def between(pattern: str) -> Column:
        return F.regexp_extract("t", pattern, 1)

    year = F.regexp_replace(strip(between(r"Academic Year ([^H]+?)Height")), r"\.$", "")
    return rows.select(
        "page_id",
        strip(between(r"Jersey Number \d+([^P]+?)Position")).alias("name"),
        between(r"Jersey Number (\d+)").alias("jersey"),
        between(r"Position ([GFC])").alias("position"),
        roster.class_name(year).alias("academic_year"),
        between(r"Height ([^H]+?)Hometown").alias("height"),
        strip(between(r"Hometown ([^L]+?)Last School")).alias("hometown"),
        strip(between(r"Last School ([^F]+?)Full Bio")).alias("high_school"),
        absolute(F.col("url"), F.col("link")).alias("url"),
    ).where(F.length("name") > 2)


_PLAYER_CLASSES = ["name", *[c for names in PLAYER_FIELDS.values() for c in names]]
_COACH_CLASSES = [*COACH_NAMES, *[c for names in COACH_FIELDS.values() for c in names]]
_CARDS = "array<struct<names:array<string>,texts:array<string>,bold:string,label:string,link:string>>"


def _card_list(page: m.Page, panels: Sequence[str], container: str, classes: Sequence[str]) -> list[int]:
    """Elements of the first card class that occurs in the first panel, else the first container, else the page."""
    within = page.by_id(*panels)
    if within is None:
        within = page.first(page.classed(container))
    return page.once(("cards", container, within), lambda: next((found for c in classes if (found := page.classed(c, within))), []))


def _class_texts(page: m.Page, card: int, classes: Sequence[str]) -> list[str | None]:
    return page.texts_of(page.once(("fields", card, len(classes)), lambda: [page.first(page.classed(c, card)) for c in classes]))


def _player_places(page: m.Page, card: int) -> tuple[list, list, list | None, int | None]:
    """Where a card has the texts of names and fields, and its first link.

    A name is taken from the name's element: the link inside a heading or to the roster, then the whole.
    """

    def headed(a: int) -> bool:
        return any(page.inside(a, h3) for h3 in page.tagged("h3", card))

    names = []
    for name in ("sidearm-roster-player-name", None, "sidearm-roster-player-name-link"):
        own = card if name is None else page.first(page.classed(name, card))
        if own is not None:
            links = [(a - card, headed(a), page.places(a, card)) for a in page.tagged("a", own)]
            names.append(([x for x in links if x[1] or name], page.places(own, card) if name else None))
    found = [(k, page.places(page.first(page.classed(c, card)), card)) for k, c in enumerate(_PLAYER_CLASSES)]
    texts = [(k, at) for k, at in found if at is not None]
    position = page.first(page.classed("sidearm-roster-player-position", card))
    bold = page.first(page.classed("text-bold", position)) if position is not None else None
    return names, texts, page.places(bold, card), _first_link(page, card)


def _player_cards(page: m.Page) -> list[dict]:
    cards = _card_list(page, PLAYER_PANELS, PLAYER_LIST, PLAYER_CARDS)
    if not cards:  # list items around a text wrapper
        parents = [page.scope[k] for k in page.classed("text-wrapper") if page.tag[k] == "div"]
        cards = [k for k in parents if k >= 0 and page.tag[k] == "li"]
    out = []
    for card in cards:
        (named, texts, bold, link), first = page.part(card, _player_places)
        attrs = {} if link is None else page.attrs[card + link]
        names = []
        for links, whole in named:
            for a, headed, at in links:
                if headed or "/roster/" in page.attrs[card + a].get("href", ""):
                    names.append(page.said(at, first))
                    break
            if whole is not None:
                names.append(page.said(whole, first))
        said = [None] * len(_PLAYER_CLASSES)
        for k, at in texts:
            said[k] = page.said(at, first)
        out.append({
            "names": names, "texts": said, "bold": page.said(bold, first),
            "label": attrs.get("aria-label"), "link": attrs.get("href", ""),
        })
    return out


def _coach_cards(page: m.Page) -> list[dict]:
    out = []
    for card in _card_list(page, COACH_PANELS, COACH_LIST, COACH_CARDS):
        if "Jersey Number" not in page.text_of(card, " ", everything=True):
            texts = _class_texts(page, card, _COACH_CLASSES)
            tags = [page.text_of(page.first(page.tagged(t, card))) for t in ("h3", "h4", "a")]
            names = [t for t in [*texts[: len(COACH_NAMES)], *tags] if t is not None][:1]
            out.append({"names": names, "texts": texts, "bold": None, "label": None, "link": page.href(card)})
    return out


def _cleaned(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.when(t.isNotNull(), roster.clean(t)))


def _filled(value: Column) -> Column:
    return let(value, lambda v: F.when(v != "", v))


def _first_of(texts: Column, test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.get(F.filter(texts, test), F.lit(0)), F.lit(""))


def _of_classes(texts: Column, every: Sequence[str], names: Sequence[str], test: Callable[[Column], Column]) -> Column:
    """The first text among some classes that passes, else ''."""
    return _first_of(F.array(*[F.get(texts, F.lit(every.index(n))) for n in names]), test)


def _filled_of_classes(texts: Column, names: Sequence[str]) -> Column:
    blank = F.lit("")
    return F.coalesce(*[F.nullif(F.get(texts, F.lit(_PLAYER_CLASSES.index(n))), blank) for n in names], blank)


def _player(card: Column) -> Column:
    def read(texts: Column) -> Column:
        fields = {f: _filled_of_classes(texts, own) for f, own in PLAYER_FIELDS.items()}
        fields["academic_year"] = roster.class_name(fields["academic_year"])
        # a position and a height may share their element, then the position is the bold part
        bold = _filled(F.get(_cleaned(F.array(card["bold"])), F.lit(0)))
        fields["position"] = let(F.coalesce(bold, fields["position"]), lambda p: F.when(p == "", "").otherwise(roster.position(p)))
        named = _filled(_first_of(_cleaned(card["names"]), lambda t: t != ""))
        name = F.coalesce(named, _filled(F.get(texts, F.lit(0))), roster.aria_name(card["label"]), F.lit(""))
        return F.struct(name.alias("name"), *[c.alias(f) for f, c in fields.items()], card["link"].alias("link"))

    return let(_cleaned(card["texts"]), read)


def player_cards(pages: DataFrame) -> DataFrame:
    """Players from repeating cards, each field from an ordered list of classes.

    Cards are looked for in the roster's panel or list if the page has one, else in the whole
    page; without any card class, list items around a text wrapper are the cards. A card may
    hold elements nested in any depth.
    """
    found = m.parsed(pages, ["page_id", "url"], _CARDS, _player_cards)
    kept = F.filter(
        F.transform("found", _player),
        lambda p: (p["name"] != "") & ~p["name"].contains("Instagram") & ~p["link"].contains("/coaches/") & ~p["link"].contains("/staff/"),
    )
    rows = _each(found, kept)
    return rows.select("page_id", "name", *PLAYER_FIELDS, absolute(F.col("_base"), F.col("link")).alias("url"))


def _coach(card: Column) -> Column:
    """Fields of a coach's card: each from the first of its elements that the card has, filled or not."""

    def read(texts: Column) -> Column:
        fields = [_of_classes(texts, _COACH_CLASSES, names, lambda t: t.isNotNull()).alias(f) for f, names in COACH_FIELDS.items()]
        return F.struct(_first_of(_cleaned(card["names"]), lambda t: t.isNotNull()).alias("name"), *fields, card["link"].alias("link"))

    return let(_cleaned(card["texts"]), read)


def coach_cards(pages: DataFrame) -> DataFrame:
    """Coaches from repeating cards, one per address, name and title in any case."""
    found = m.parsed(pages, ["page_id", "url"], _CARDS, _coach_cards)
    kept = F.filter(F.transform("found", _coach), lambda p: p["name"] != "")
    rows = found.select("page_id", F.col("url").alias("_base"), F.posexplode_outer(kept).alias("at", "p")).where(F.col("at").isNotNull())
    built = rows.select("page_id", "at", "p.name", *[f"p.{f}" for f in COACH_FIELDS], absolute(F.col("_base"), F.col("p.link")).alias("url"))
    keys = {"_u": F.lower("url"), "_n": F.lower("name"), "_t": F.lower("title")}
    return first_per_key(built.withColumns(keys), ["page_id", *keys], [F.col("at")]).drop("at", *keys)


def coach_as_roster(coaches: DataFrame, team: str, season: Column) -> DataFrame:
    """Coach fields in the roster's columns: title as position, school as hometown."""
    blank = F.lit("")
    return coaches.select(
        team, "name", F.col("title").alias("position"), F.col("experience").alias("academic_year"), F.col("alma_mater").alias("hometown"),
        blank.alias("high_school"), blank.alias("previous_school"), blank.alias("height"), blank.alias("jersey"), "url", season.alias("season"),
    )


_STAFF = "array<struct<headed:boolean,rows:array<struct<cells:array<string>,name:string,link:string>>>>"


def _staff_tables(page: m.Page) -> list[dict]:
    """The table after each coach heading, then the main one."""
    headings = sorted(k for tag in ("h2", "h3", "h4") for k in page.tagged(tag) if "coach" in page.text_of(k, everything=True).lower())
    tables = [(True, page.after("table", k)) for k in headings]
    named = [k for k in page.tagged("table") if page.attrs[k].get("id") == "players-table__general"]
    tables.append((False, page.first(named or page.tagged("table"))))

    def row(r: int) -> dict:
        links = page.tagged("a", r)
        name = page.text_of(links[0]) if links else None
        return {"cells": [page.text_of(c) for c in page.cells(r)], "name": name, "link": page.attrs[links[0]].get("href", "") if links else None}

    return [{"headed": headed, "rows": [row(r) for r in _shape(page, t)[1]]} for headed, t in tables if t is not None]


def coach_table_rows(pages: DataFrame) -> DataFrame:
    """Coaches from the first table after a coach heading that gives any, else from rows of the main table that mention one."""

    def coaches(table: Column) -> Column:
        return F.filter(
            F.transform(table["rows"], _coach_row),
            lambda r: (r["cells"] >= 2) & (table["headed"] | r["mentions"]) & (r["name"] != "") & (r["title"] != ""),
        )

    found = m.parsed(pages, ["page_id", "url"], _STAFF, _staff_tables)
    named = _each(found, F.get(F.filter(F.transform("found", coaches), lambda rows: F.size(rows) > 0), F.lit(0)))
    link = F.when(F.col("linked"), absolute(F.col("_base"), F.col("link"))).otherwise(F.col("_base"))
    return named.select("page_id", "name", "title", link.alias("url"))


def _coach_row(row: Column) -> Column:
    def read(cells: Column) -> Column:
        title = F.get(F.filter(cells, lambda t: F.lower(t).rlike("|".join(COACH_WORDS))), F.lit(0))
        name = F.coalesce(F.get(_cleaned(F.array(row["name"])), F.lit(0)), F.get(cells, F.lit(0)))
        return F.struct(
            F.size(cells).alias("cells"), F.lower(F.array_join(cells, " ")).rlike("|".join(COACH_ROWS)).alias("mentions"), name.alias("name"),
            F.coalesce(title, F.lit("")).alias("title"), row["link"].isNotNull().alias("linked"), F.coalesce(row["link"], F.lit("")).alias("link"),
        )

    return let(_cleaned(row["cells"]), read)


def carry(df: DataFrame, page: Sequence[str], at: str, marker: Column, value: Column, out: str) -> DataFrame:
    """Value of the latest marker row at or before each row of a page (null values carried too).

    One page's blocks come from one stored document, so a partition is no larger
    than the document was.
    """
    window = Window.partitionBy(*page).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    held = F.last(F.when(marker, F.struct(value.alias("v"))), ignorenulls=True).over(window)
    return df.withColumn(out, held["v"])


def sectioned_list(pages: DataFrame, blog: str) -> DataFrame:
    """Coaching changes: status from h2, school from h3, one row per item of a list.

    A list inside an item is a list of its own, and its text is part of the item's.
    """

    def item(page: m.Page, li: int) -> dict:
        links = [page.attrs[a]["href"] for a in page.tagged("a", li) if blog not in page.attrs[a].get("href", blog)]
        coach = (page.text_of(page.first(page.tagged("strong", li))) or "").strip()
        return {"text": page.text_of(li, " "), "coach": coach, "url": links[0] if links else None}

    def read(page: m.Page) -> list[dict]:
        out = []
        for k in sorted([*page.tagged("h2"), *page.tagged("h3"), *page.tagged("ul")]):
            if page.tag[k] == "ul":
                own = [li for li in page.tagged("li", k) if page.scope[li] == k]
                out.append({"at": k, "tag": "ul", "t": None, "items": [item(page, li) for li in own]})
            else:
                out.append({"at": k, "tag": page.tag[k], "t": page.text_of(k).strip(), "items": None})
        return out

    kind = "array<struct<at:int,tag:string,t:string,items:array<struct<text:string,coach:string,url:string>>>>"
    parts = m.parsed(pages, ["page_id"], kind, read).select("page_id", F.inline("found"))
    heading = F.upper("t")
    status = F.when(heading.contains("JOBS OPEN"), "Jobs Open").when(heading.contains("JOBS FILLED"), "Jobs Filled")
    is_h2, is_h3 = F.col("tag") == "h2", F.col("tag") == "h3"
    school, conference = titles.school_and_conference(F.col("t"))
    place = F.when(is_h3, F.struct(school.alias("school"), conference.alias("conference")))
    rows = carry(parts, ["page_id"], "at", is_h2, status, "status")
    rows = carry(rows, ["page_id"], "at", is_h2 | is_h3, place, "place")
    rows = rows.where((F.col("tag") == "ul") & F.col("status").isNotNull() & F.col("place").isNotNull())
    entries = rows.select("page_id", "status", "place", F.inline("items"))
    entries = entries.withColumn("text", F.regexp_replace(squish("text"), r"\s+([).,;])", "$1"))
    return entries.select(
        "page_id",
        "status",
        "place.school",
        "place.conference",
        "coach",
        titles.role_of_post(F.col("text")).alias("role"),
        "text",
        month_name_date(F.col("text")).alias("date"),
        "url",
    )


def sectioned_lines(pages: DataFrame) -> DataFrame:
    """Transfers: team from h2, In or Out from underlined text, one row per bullet line."""
    parts = pages.select("page_id", F.posexplode(h.blocks(F.col("html"), "h2", "p")).alias("at", "b"))
    heading = F.substring("b", 2, 1).isin("h", "H")
    # only a heading's text is wanted here; a paragraph's is taken line by line
    parts = parts.withColumn("t", F.when(heading, squish(h.text_of(F.col("b")))))
    is_team = F.col("t").isNotNull() & ~F.col("t").rlike(r"(?i)\bback\b|\bpage\b")
    teams = carry(parts, ["page_id"], "at", is_team, F.col("t"), "team")
    paragraphs = teams.where(F.col("t").isNull() & F.col("team").isNotNull())
    lines = paragraphs.select("page_id", "at", "team", F.posexplode(F.split("b", r"(?i)<br\s*/?>")).alias("line", "g"))
    under = F.regexp_extract("g", r'(?is)<span\s[^>]*style="[^"]*underline[^"]*"[^>]*>(.*?)</span>', 1)
    # most lines have no underlined text, and need no cleaning of it
    lines = lines.withColumn("_s", F.when(under != "", let(strip(h.text_of(under)), _in_or_out)))
    lines = carry(lines, ["page_id", "at"], "line", F.col("_s").isNotNull(), F.col("_s"), "status")
    players = lines.where(F.col("_s").isNull() & F.col("status").isNotNull())
    bold = h.text_of(F.get(h.inner(F.col("g"), "strong"), F.lit(0)))
    text = h.text_of(F.col("g"))
    entry = let(bold, lambda b: F.when(b.contains("•"), roster.player_line(b, text)))
    # a filter on the entry's name would work the entry out twice, below a generator it cannot go
    made = players.select("page_id", "team", "status", F.inline_outer(F.array(entry)))
    return made.where("name <> ''")


def _in_or_out(text: Column) -> Column:
    # by pattern, since upper-casing each text takes longer than all else here; a dotless i is an I in upper case
    return F.when(text.rlike(r"\A[iIı][nN]\z"), "In").when(text.rlike(r"\A[oO][uU][tT]\z"), "Out")


def extract_or_miss(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable text per page, and the pages that gave none."""
    texts = pages.select("page_id", "url", h.visible_text(F.col("html")).alias("text"))
    return texts.where(F.coalesce("text", F.lit("")) != ""), texts.where(F.coalesce("text", F.lit("")) == "").select("page_id", "url")
