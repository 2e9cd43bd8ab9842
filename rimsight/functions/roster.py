"""Roster fields: cleaning, extraction, recoding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rimsight.functions.dates import portal_date
from rimsight.functions.strings import first_match, let, map_values, squish, strip
from rimsight.functions.titles import transfer_history

# fixed values: label patterns in the order they are removed, any case
LABEL_PATTERNS = [
    r"\bHometown / Previous School / High School:\s*",
    r"\bHometown / Previous School /\s*",
    r"\bHometown/High School \(Former School\):\s*",
    r"\bHometown / High School:\s*",
    r"\bHigh School/Previous School:\s*",
    r"\bHigh School/\s*",
    r"\bHometown/\s*",
    r"\bClass:\s*",
    r"\bPrevious College:\s*",
    r"\bPrevious School:\s*",
    r"\bHt\.:\s*",
    r"\bPos\.:\s*",
    r"^High school:\s*",
    r"\bNo\.:\s*",
    r"\bYr\.:\s*",
    r"\bCl\.:\s*",
    r"^\s*Hometown\s*:?\s*$",
    r"\bHigh school:\s*",
    r"\bHometown:\s*",
]
_WORDS, _REST = [p for p in LABEL_PATTERNS if p.startswith(r"\b")], [p for p in LABEL_PATTERNS if not p.startswith(r"\b")]
# any label; those that begin with a word are tried only where one with a fitting letter begins
ANY_LABEL = rf"(?i)(?:\b(?=[hpcny])(?:{'|'.join(p.removeprefix(r'\b') for p in _WORDS)})|{'|'.join(_REST)})"
JERSEY_PATTERNS = [r"Jersey Number (\d+)", r"#(\d{1,2})\b", r"\b(\d{1,2})\s+\w"]
HEIGHT_PATTERNS = [r"(\d+'\s*\d+\")", r"(\d+[′']\s*\d+[″\"])", r"Height:\s*([^,\n]+)"]
POSITION_PATTERN = r"\b([A-Z]{1,2}(?:/[A-Z]{1,2})?)\b"
SOCIAL_WORDS = ["Instagram", "Twitter", "Opens in a new window"]
SOCIAL_TAIL = rf"\s*({'|'.join(SOCIAL_WORDS)}).*$"
BIO_WORDS = ["Full Bio", "Instagram", "Twitter", "Opens in a new window"]
# up to three words with single blanks, no label and no caption: nothing to clean; the words first, since that fails soon
PLAIN_TEXT = r"(?s)\A(?=(?:[^\s:/]++(?: [^\s:/]++){0,2}+)?\z)(?!.*(?:Full Bio|Instagram|Twitter|[hH](?i:ometown)))"
BIO_TAIL = rf"\s*({'|'.join(BIO_WORDS)}).*$"
CITY_STATE = r"^(.+?),\s*([A-Z][a-z]+\.?|[A-Z]{2})\s+(.*)"
COLLEGE_WORDS = ["University", "College", "State", "Tech"]

# fixed values: class abbreviations
CLASS_NAMES = {
    "Fr": "Freshman", "Fr.": "Freshman", "So": "Sophomore", "So.": "Sophomore", "Jr": "Junior", "Jr.": "Junior",
    "Sr": "Senior", "Sr.": "Senior", "Gr": "Graduate", "Gr.": "Graduate Student",
    "R-Fr": "Redshirt Freshman", "R-Fr.": "Redshirt Freshman", "R-So": "Redshirt Sophomore",
    "R-So.": "Redshirt Sophomore", "R-Jr": "Redshirt Junior", "R-Jr.": "Redshirt Junior",
    "R-Sr": "Redshirt Senior", "R-Sr.": "Redshirt Senior",
}
# fixed values: spellings of each class
CLASS_SPELLINGS = {
    "Senior": ["Sr.", "Sr", "SR", "Senior*", "Senior+"],
    "Junior": ["Jr.", "Jr", "JR", "Jr.-Tr.", "Jr.-1L", "Jr.-2L"],
    "Sophomore": ["So.", "So", "SO", "So.-1L", "So.-Tr."],
    "Freshman": ["Fr.", "FR", "First-year", "First-Year Student", "Fr.-HS", "First Year", "First-Year", "Fy.", "Fy", "FY", "Fr"],
    "Graduate Student": ["Gr.", "Gr", "GR", "Grad", "Grad.", "Graduate"],
    "Redshirt Freshman": ["RFr.", "RFr", "R-Fr.", "Fr.-RS", "Fr. (rs)"],
    "Redshirt Sophomore": ["r-So.", "R-So.", "So. (rs)", "Redshirt-Sophomore", "RSo", "RSo."],
    "Redshirt Junior": ["R-Jr.", "RS Jr.", "Jr.-R", "R-Junior", "Jr. (rs)"],
    "Redshirt Senior": ["RSr.", "RSr*", "RSr", "RS Senior", "Redshirt-Senior"],
}
CLASS_RECODE = {spelling: label for label, spellings in CLASS_SPELLINGS.items() for spelling in spellings}
# fixed values: spellings of each position
POSITION_SPELLINGS = {
    "G": ["Guard", "guard", "G.", "Gaurd", "Guard/", "GUARD"],
    "PG": ["Point", "Point Guard", "Point-Guard"],
    "PG/SG": ["Point/Shooting"],
    "SG/PG": ["Shooting/Point"],
    "SG": ["Shooting"],
    "F": ["Forward", "FWD"],
    "C": ["Center"],
    "G/F": ["Guard/Forward", "G / F", "G | F", "Guard-Forward", "Guard/Forawrd", "Guard/Foward"],
    "F/C": ["Forward/Center", "FWD/C"],
}
POSITION_RECODE = {spelling: label for label, spellings in POSITION_SPELLINGS.items() for spelling in spellings}
# fixed values: header spellings of each field
HEADER_SPELLINGS = {
    "jersey": ["No.", "Number", "Num", "#", "No", "NO.", "NO", "#Jersey Number", "NumberJersey Number"],
    "name": ["Name", "Full Name", "NAME", "Player"],
    "academic_year": [
        "Cl.", "Academic Year", "Class", "Yr", "Exp.", "YEAR", "Yr.", "Cl.-Exp.", "Cl.:", "Year", "Cl", "YR", "YR.", "Academic Yr.",
    ],
    "high_school": ["High school", "High School/Previous School", "LAST SCHOOL", "High School", "HIGH SCHOOL"],
    "previous_school": ["Previous School", "Previous College", "Prev. Coll."],
    "position": ["Pos.", "Pos", "Position", "POS", "POS.", "POSITION"],
    "height": ["Ht.", "Ht", "HT.", "Height", "Hgt.", "HT"],
    "hometown": ["Hometown", "HOMETOWN"],
    "town": [
        "Hometown/High School", "Hometown / High School", "Hometown/Last School", "Hometown/Previous School",
        "Hometown/High School/Last School", "Hometown / Previous School", "Hometown/High School/Previous School",
        "Hometown / High School / Last College", "Hometown/ High School", "HOMETOWN/HIGH SCHOOL",
        "Hometown / Previous School / High School", "Hometown/High School (Former School)",
    ],
    "major": ["Major"],
    "weight": ["Wt."],
    "letters": ["Ltrs."],
}
HEADER_FIELDS = {spelling: field for field, spellings in HEADER_SPELLINGS.items() for spelling in spellings}
UNWANTED_HEADERS = ["Social", "Pronounciation", "Pronouns"]


def without_labels(text: Column) -> Column:
    """Field labels removed, then an exactly repeated full name collapsed."""
    return let(let(text, _unlabelled), lambda t: _one_name(t, r"\s+"))


def _unlabelled(text: Column) -> Column:
    """Labels removed one pattern after another.

    Removing all in one pass gives the same unless what is left has a label again: a pattern that
    begins inside another's match ends with it and stands later in the list.
    """
    out = text
    for pattern in LABEL_PATTERNS:
        out = strip(F.regexp_replace(out, f"(?i){pattern}", ""))
    at_once = strip(F.regexp_replace(text, ANY_LABEL, ""))
    again = let(at_once, lambda t: F.when(_may_have_label(t) & t.rlike(ANY_LABEL), out).otherwise(t))
    return F.when(_may_have_label(text), again).otherwise(strip(text))


def _may_have_label(text: Column) -> Column:
    """Every label has a colon, a slash or is the word itself."""
    return text.contains(":") | text.contains("/") | F.lower(text).contains("hometown")


def _one_name(text: Column, blank: str) -> Column:
    def once(words: Column) -> Column:
        half = F.floor(F.size(words) / 2).cast("int")
        front = F.slice(words, 1, half)
        twice = (F.size(words) >= 4) & (front == F.slice(words, half + 1, half))
        return F.when(twice, F.array_join(front, " ")).otherwise(text)

    return let(F.split(strip(text), blank), once)


def clean(text: Column) -> Column:
    """Whitespace squeezed, link captions cut, labels removed; missing as ''."""

    def cut(squeezed: Column) -> Column:
        captioned = reduce(lambda a, b: a | b, [squeezed.contains(word) for word in BIO_WORDS])
        return F.when(captioned, F.regexp_replace(squeezed, BIO_TAIL, "")).otherwise(squeezed)

    def whole(stripped: Column) -> Column:
        squeezed = let(squish(stripped), cut)
        return let(let(squeezed, _unlabelled), lambda t: F.when(t.contains(" "), _one_name(t, " ")).otherwise(t))

    return let(strip(F.coalesce(text, F.lit(""))), lambda t: F.when(t.rlike(PLAIN_TEXT), t).otherwise(whole(t)))


def jersey(text: Column) -> Column:
    return first_match(text, JERSEY_PATTERNS)


def height(text: Column) -> Column:
    return strip(first_match(text, HEIGHT_PATTERNS))


def position(text: Column) -> Column:
    return let(text, _position)


def _position(text: Column) -> Column:
    upper = F.upper(text)
    word = F.when(upper.contains("GUARD"), "G").when(upper.contains("FORWARD"), "F").when(upper.contains("CENTER"), "C")
    return let(F.regexp_extract(text, POSITION_PATTERN, 1), lambda code: F.when(code != "", code).otherwise(F.coalesce(word, F.lit(""))))


def class_name(text: Column) -> Column:
    """Full class name of an abbreviation; other text passes unchanged."""
    return let(text, lambda t: map_values(strip(t), CLASS_NAMES, t))


def recode_class(text: Column, default: Column) -> Column:
    return map_values(text, CLASS_RECODE, default)


def recode_position(text: Column, default: Column) -> Column:
    return map_values(text, POSITION_RECODE, default)


def header_field(header: Column) -> Column:
    """Field of a table header; unknown headers in snake case."""
    return map_values(header, HEADER_FIELDS, F.replace(F.lower(header), F.lit(" "), F.lit("_")))


def town_parts(text: Column) -> Column:
    """Hometown, high school and previous school from one combined cell."""
    def cut(whole: Column) -> Column:
        captioned = reduce(lambda a, b: a | b, [whole.contains(word) for word in SOCIAL_WORDS])
        return squish(F.when(captioned, F.regexp_replace(whole, SOCIAL_TAIL, "")).otherwise(whole))

    return let(let(F.coalesce(text, F.lit("")), cut), _town_parts)


def _town_parts(t: Column) -> Column:
    blank = F.lit("")

    def made(hometown: Column, high_school: Column, previous_school: Column) -> Column:
        return F.struct(hometown.alias("hometown"), high_school.alias("high_school"), previous_school.alias("previous_school"))

    def slashed(parts: Column) -> Column:
        return made(*[F.coalesce(strip(F.get(parts, F.lit(i))), blank) for i in range(3)])

    city, state, rest = (F.regexp_extract(t, CITY_STATE, i) for i in (1, 2, 3))
    school, previous = F.when(F.lit(False), blank), F.when(F.lit(False), blank)
    for word in COLLEGE_WORDS:
        before = F.substring_index(rest, word, 1)
        school = school.when(rest.contains(word), strip(before))
        previous = previous.when(rest.contains(word), strip(_from(rest, before)))
    placed = made(F.concat_ws(", ", strip(city), strip(state)), school.otherwise(strip(rest)), previous.otherwise(blank))
    return F.when(t.contains(" / "), let(F.split(t, " / "), slashed)).when(t.rlike(CITY_STATE), placed).otherwise(made(t, blank, blank))


def _from(text: Column, before: Column) -> Column:
    return F.substr(text, F.length(before) + 1)


def town_with_state(hometown: Column, opted_in: Column, state: Column) -> Column:
    """State added to a hometown without one, only for teams that ask for it."""
    needs = opted_in & (hometown != "") & ~hometown.contains(",") & state.isNotNull() & (state != "")
    return F.when(needs, F.concat_ws(", ", hometown, state)).otherwise(hometown)


def aria_name(label: Column) -> Column:
    """Name from an accessibility label; labels of images give ''."""
    plain = strip(F.replace(label, F.lit(" full bio"), F.lit("")))
    before = strip(F.substring_index(plain, " jersey number ", 1))
    named = F.when(label.contains(" - "), strip(F.substring_index(label, " - ", 1))).otherwise(before)
    return F.when(F.lower(label).contains("image thumbnail"), "").otherwise(named)


def fill(value: Column, other: Column) -> Column:
    """The value, or the other record's where it is empty."""
    return F.coalesce(F.nullif(value, F.lit("")), other, F.lit(""))


def feet_inches(feet: Column, inches: Column) -> Column:
    """``6-2`` when both numbers are plausible, else ''."""
    f, i = feet.try_cast("int"), inches.try_cast("int")
    return F.when(f.between(4, 7) & i.between(0, 11), F.format_string("%d-%d", f, i)).otherwise("")


PLAYER_LINE = r"(?i)^(\d-\d{1,2})\s+((?:RS\s+)?(?:FR|SO|JR|SR|GR))\s+([^,{(→]+)"


def player_line(bold: Column, line: Column) -> Column:
    """One transfer entry: name, height, year, position, hometown, portal date, history."""
    name = strip(F.substring_index(strip(F.regexp_replace(strip(bold), "^•+", "")), ",", 1))
    text = F.regexp_replace(squish(line), r"^[•\s]+", "")
    brace = lambda t: F.regexp_extract(t, r"\{([^}]+)\}", 1)
    return let(name, lambda n: let(text, lambda t: let(brace(t), lambda b: let(_after_name(n, t), lambda rest: _player(n, b, rest)))))


def _after_name(name: Column, text: Column) -> Column:
    cut = lambda lead: strip(F.regexp_replace(F.substr(lead, F.length(name) + 1), "^,+", ""))
    after = let(strip(F.substring_index(text, "{", 1)), lambda lead: F.when(lead.startswith(name), cut(lead)).otherwise(lead))
    return strip(F.regexp_replace(after, r"\s*→.*$", ""))


def _player(name: Column, brace: Column, rest: Column) -> Column:
    hit = rest.rlike(PLAYER_LINE)
    matched = F.regexp_replace(F.regexp_extract(rest, PLAYER_LINE, 0), r"\s+$", "")
    tail = strip(F.regexp_replace(F.substr(rest, F.length(matched) + 1), "^,+", ""))
    tail = strip(F.regexp_replace(tail, r"\s*\([^)]+\)\s*$", ""))
    tail = strip(F.regexp_replace(tail, r"\s*/[^{]+$", ""))
    return F.struct(
        name.alias("name"),
        F.when(hit, F.regexp_extract(rest, PLAYER_LINE, 1)).alias("height"),
        F.when(hit, squish(F.regexp_extract(rest, PLAYER_LINE, 2))).alias("year"),
        F.when(hit, strip(F.regexp_extract(rest, PLAYER_LINE, 3))).alias("position"),
        F.when(hit, let(tail, lambda t: F.nullif(t, F.lit("")))).alias("hometown"),
        portal_date(brace).alias("entered_portal"),
        transfer_history(brace).alias("transfer_history"),
    )
