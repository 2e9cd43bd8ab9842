"""String expressions: join keys, slugs, name casing, made-attempted splits."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: Latin letters that join as others, beyond those made of a base letter and marks
SPECIAL = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ı": "i", "ſ": "s", "ŋ": "n", "ĸ": "k", "ẞ": "SS", "Æ": "AE", "Œ": "OE", "Þ": "TH", "Ð": "D", "Ŋ": "N"}


def latin_letters() -> dict[str, str]:
    """Letters of U+00C0 to U+024F and the plain ones they join as.

    What a letter decomposes to, else the letter its name says it is a variant of (stroke, hook).
    """
    found = {}
    for code in range(0xC0, 0x250):
        letter = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if c.isascii() and c.isalpha())
        named = re.fullmatch(r"LATIN (CAPITAL|SMALL) LETTER ([A-Z]) WITH .*", unicodedata.name(letter, ""))
        if not plain and named:
            plain = named[2] if named[1] == "CAPITAL" else named[2].lower()
        if plain:
            found[letter] = plain
    return {**found, **SPECIAL}


LETTERS = latin_letters()
ACCENTED = "".join(k for k, v in LETTERS.items() if len(v) == 1)
PLAIN = "".join(v for v in LETTERS.values() if len(v) == 1)
DOUBLE = {k: v for k, v in LETTERS.items() if len(v) > 1}


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_ascii(value: Column | str) -> Column:
    """Accents and Latin letter variants replaced; text of one byte a letter passes at once."""

    def replaced(text: Column) -> Column:
        out = text
        for letter, plain in DOUBLE.items():
            out = F.replace(out, F.lit(letter), F.lit(plain))
        return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.translate(out, ACCENTED, PLAIN))

    return let(_column(value), replaced)


def join_key(value: Column | str, transliterate: bool = True) -> Column:
    """Lower-case letters and digits only, accents removed first."""
    text = to_ascii(value) if transliterate else _column(value)
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body names it.

    The finishing step of a fold over no elements: picking the element of a one-element
    ``transform`` works out the type of the whole body again for each row.
    """
    return F.aggregate(F.array(), value, lambda kept, _: kept, body)


def first_filled(*values: Column) -> Column:
    """The first value that is neither missing nor empty, else ''."""
    return F.coalesce(F.get(F.filter(F.array(*values), lambda v: v != ""), F.lit(0)), F.lit(""))


def strip(value: Column | str) -> Column:
    """Whitespace off both ends, line breaks included."""
    return F.btrim(_column(value), F.lit(" \t\n\x0b\f\r"))


def squish(value: Column | str) -> Column:
    """Runs of whitespace to one blank, ends stripped."""
    # single blanks, most of all runs, stay as they are; only blanks are left at the ends
    return F.trim(F.regexp_replace(_column(value), r"[\t\n\x0B\f\r]\s*+| \s++", " "))


def chain(value: Column | str, steps: list[tuple[str, str]]) -> Column:
    """Regular-expression replacements one after another."""
    out = _column(value)
    for pattern, replacement in steps:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def team_slug(team_id: Column, name: Column) -> Column:
    """Id, lower-case name, blanks as hyphens, punctuation dropped."""
    plain = F.translate(F.translate(F.lower(name), " ", "-"), ".,'()", "")
    return F.concat_ws("-", team_id.cast("string"), plain)


def competition_slug(name: Column, year: Column) -> Column:
    slug = chain(F.lower(name), [(r"\s+", "-"), (r"[^a-z0-9\-]", ""), (r"-+", "-"), (r"^-+|-+$", "")])
    return F.concat_ws("-", slug, year.cast("string"))


def title_case(value: Column | str) -> Column:
    """Capital after every non-letter, the rest lower (O'Brien, not O'brien)."""
    runs = F.regexp_extract_all(_column(value), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2)))))
    return F.array_join(cased, "")


def name_list(value: Column | str) -> Column:
    """Names from comma text: stripped, double blanks once to single, cased."""
    parts = F.split(_column(value), ",")
    return F.transform(parts, lambda p: title_case(F.replace(strip(p), F.lit("  "), F.lit(" "))))


def made_attempted(value: Column | str) -> tuple[Column, Column]:
    """Both numbers of ``7-15`` or ``7/15``; null where not a number."""
    parts = F.split(_column(value), "[-/]", 2)
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def percent(value: Column | str) -> Column:
    return F.replace(_column(value), F.lit("%"), F.lit("")).try_cast("double")


def clock_seconds(value: Column | str) -> Column:
    """Seconds of ``MM:SS`` or ``MM:SS:00``; zero when blank."""
    parts = F.split(F.coalesce(_column(value), F.lit("")), ":")
    total = F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int")
    return F.when(F.size(parts) >= 2, total).otherwise(0)


def or_blank(value: Column | str) -> Column:
    """Missing as ''."""
    return F.coalesce(_column(value).cast("string"), F.lit(""))


def falsy_blank(value: Column | str) -> Column:
    """Missing, '', 0 and false all as ''."""
    text = _column(value).cast("string")
    return F.when(text.isNull() | text.isin("0", "0.0", "false"), "").otherwise(text)


def game_file_id(value: Column | str) -> Column:
    return F.substring_index(_column(value), "&", 1)


def map_values(value: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """Value from a fixed table, else the default (the value itself)."""
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, value), value if default is None else default)


def first_match(value: Column, patterns: list[str], group: int = 1) -> Column:
    """The group of the first pattern that matches, else ''."""

    def tried(text: Column) -> Column:
        hits = [F.when(text.rlike(p), F.regexp_extract(text, p, group)) for p in patterns]
        return F.coalesce(*hits, F.lit(""))

    return let(value, tried)
