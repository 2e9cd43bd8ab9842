"""Roster addresses, hosts, ids in links and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: path of each named format after the base; {p} path, {s} season, {y} first year, {f} four-digit form, {n} next season
FORMATS = {
    "default": "/{p}/{s}",
    "direct": "/{p}/",
    "season_first": "/{s}/{p}",
    "season_first_table": "/{s}/{p}?view=list",
    "season_path": "/{p}/season/{s}/",
    "season_path_table": "/{p}/season/{s}?view=table",
    "clemson": "/{p}/season/{y}",
    "iowa_table": "/{p}/season/{s}?view=table",
    "valpo": "/{p}/{s}/?view=list",
    "la_salle": "/{p}/{f}",
    "byu_table": "/{p}/season/{f}?view=table",
    "four_digit_year": "/{p}/{f}",
    "next_year": "/{p}/{n}",
}


def _fill(template: str, values: dict[str, Column]) -> Column:
    out: list[Column] = []
    rest = template
    while rest:
        literal, brace, rest = rest.partition("{")
        if literal:
            out.append(F.lit(literal))
        if brace:
            key, _, rest = rest.partition("}")
            out.append(values[key])
    return F.concat(*out)


def roster_url(base: Column, season: Column, url_format: Column, entity: Column) -> Column:
    """Roster or coaches address from the site's format and host rules."""
    start, short = F.substring(season, 1, 4), F.substr(season, F.lit(-2))
    root = F.regexp_replace(base, "/+$", "")
    coach = entity == "coach"
    following = F.format_string("%d-%02d", start.try_cast("int") + 1, short.try_cast("int") + 1)
    values = {
        "p": F.when(coach, "coaches").otherwise("roster"),
        "s": season,
        "y": start,
        "f": F.concat(start, F.lit("-"), F.substring(season, 1, 2), short),
        "n": following,
    }

    def at(prefix: str, template: str) -> Column:
        return F.concat(F.lit(prefix), _fill(template, values))

    def under(template: str) -> Column:
        return F.concat(root, _fill(template, values))

    def on(host: str) -> Column:
        return root.startswith(f"https://{host}")

    named = F.when(F.lit(False), root)
    for name, template in FORMATS.items():
        named = named.when(url_format == name, under(template))
    iowa = (
        F.when(coach, under("/roster/season/{s}?tab=coaches"))
        .when(root.contains("/wbball"), under("/roster/season/{s}?view=table"))
        .otherwise(under("/sports/wbball/roster/season/{s}?view=table"))
    )
    return (
        F.when(base.contains(F.concat(F.lit("/"), season)) | (url_format == "direct_url"), F.concat(base, F.lit("/"), season))
        .when(on("arkansasrazorbacks.com"), at("https://arkansasrazorbacks.com/sport/w-baskbl/", "{p}/?season={s}"))
        .when(on("goaztecs.com"), at("https://goaztecs.com/sports/womens-basketball/", "{p}/season/{s}?view=table"))
        .when(on("miamihurricanes.com"), under("/roster/season/{s}/"))
        .when(on("hawkeyesports.com"), iowa)
        .when(on("gomason.com") | on("miamiredhawks.com"), under("/roster/{s}"))
        .when(on("hawaiiathletics.com"), under("/{p}/{f}"))
        .otherwise(named.otherwise(under(FORMATS["default"])))
    )


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def absolute(base: Column, link: Column) -> Column:
    """Full address of a link: '' stays, full links stay, else joined to the base."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"([^:/])/[^/]*$", "$1/")
    return (
        F.when(F.coalesce(link, F.lit("")) == "", "")
        .when(link.startswith("http"), link)
        .when(link.startswith("//"), F.concat(F.substring_index(base, "//", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(folder, link))
    )


def event_and_year(file: Column) -> tuple[Column, Column]:
    """Event and four-digit year of ``event_2019_players_game_stats.csv``."""
    pattern = r"([^/_]+)_(\d{4})_"
    return F.regexp_extract(file, pattern, 1), F.regexp_extract(file, pattern, 2)


def event_slug(link: Column) -> Column:
    """Slug ``/region/...women.../yyyy`` of a women's event link; null for others and game lists."""
    found = F.regexp_extract(link, r"/([^/]+/[^/]*women[^/]*/\d{4})", 1)
    wanted = F.lower(link).contains("women") & ~link.contains("/games") & (found != "")
    return F.when(wanted, F.concat(F.lit("/"), found))


def link_game_id(link: Column) -> Column:
    """Numeric tail of a box-score link, or its id parameter."""
    tail = F.regexp_extract(F.regexp_replace(link, "/+$", ""), r"/(\d+)$", 1)
    parameter = F.replace(F.get(F.split(link, "="), F.lit(1)), F.lit("&path"), F.lit(""))
    return F.coalesce(F.nullif(tail, F.lit("")), F.when(parameter.rlike(r"^\d+$"), parameter))


def history_team_id(link: Column) -> Column:
    """Stable team id: the fourth path part of a history link, else ''."""
    return F.when(link.contains("/history/"), F.coalesce(F.get(F.split(link, "/"), F.lit(4)), F.lit(""))).otherwise("")
