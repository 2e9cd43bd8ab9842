"""Labels and facts from biography text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: pronouns of each class
PRONOUNS = {"F": ["she", "her", "hers"], "M": ["he", "him", "his"], "N": ["they", "them", "their"]}
# fixed values: degree words of each level
DEGREES = {
    "Bachelors": r"(?i)\bbachelor|\bB\.A\.|\bB\.S\.",
    "Masters": r"(?i)\bmaster's|\bmaster of|\bM\.A\.|\bM\.S\.|\bMBA\b",
    "Doctorate": r"(?i)\bPh\.?D\b|\bdoctorate",
}
DEGREE_SAMPLES = ["bachelor's degree", "Master's in law", "Ph.D. in biology", "B.A. and an MBA", "certificate"]
YEAR_RANGE = r"(?:19|20)\d\d[-–](?:(?:19|20)\d\d|\d\d)"
SINCE = r"(?i)(?:since|announced on [A-Za-z]+\.? \d{1,2},) ((?:19|20)\d\d)"
# fixed values: country spellings
COUNTRY_NAMES = {
    "Bosnia & Herzegovina": "Bosnia and Herzegovina",
    "People's Republic of China": "China",
    "Slovak Republic": "Slovakia",
    "United States of America": "USA",
    "Virgin Islands": "US Virgin Islands",
}
CAREER_SCHEMA = (
    "positions array<struct<college:string,title:string,start_year:int,end_year:int>>, "
    "education array<struct<college:string,degree:string,year:int>>, "
    "playing_career array<struct<team:string,level:string,start_year:int,end_year:int>>"
)


def pronoun_class(text: Column) -> Column:
    """Class with strictly the most whole-word pronouns; null when none leads."""
    low = F.lower(text)
    f, m, n = (F.regexp_count(low, F.lit(rf"(?U)\b(?:{'|'.join(words)})\b")) for words in PRONOUNS.values())
    return F.when((f > m) & (f > n), "F").when((m > f) & (m > n), "M").when((n > f) & (n > m), "N")


def career_json(reply: Column) -> Column:
    """The JSON object inside noisy text; empty arrays unless the required keys are there."""
    body = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    parsed = F.from_json(body, CAREER_SCHEMA)
    ok = F.get_json_object(body, "$.positions").isNotNull() & F.get_json_object(body, "$.education").isNotNull()
    fields = []
    for part in CAREER_SCHEMA.split(", "):
        name, kind = part.split(" ", 1)
        value = F.when(ok, F.coalesce(parsed[name], F.array().cast(kind))).otherwise(F.array().cast(kind))
        fields.append(value.alias(name))
    return F.struct(*fields)


def career_facts(text: Column) -> Column:
    """Year ranges, years named by since or announced, and degree levels."""
    spans = F.regexp_extract_all(text, F.lit(f"({YEAR_RANGE})"), F.lit(1))
    start = lambda s: F.substring(s, 1, 4)
    tail = lambda s: F.substring(s, 6, 4)

    def full_end(s: Column) -> Column:
        short = F.concat(F.substring(s, 1, 2), tail(s)).cast("int")
        rolled = F.when(short < start(s).cast("int"), short + 100).otherwise(short)
        return F.when(F.length(tail(s)) == 4, tail(s).cast("int")).otherwise(rolled)

    ranges = F.transform(
        spans,
        lambda s: F.struct(
            start(s).cast("int").alias("start_year"), full_end(s).alias("end_year"), start(s).alias("start_text"), tail(s).alias("end_text")
        ),
    )
    since = F.regexp_extract_all(text, F.lit(SINCE), F.lit(1))
    degrees = F.array_compact(F.array(*[F.when(text.rlike(p), name) for name, p in DEGREES.items()]))
    return F.struct(ranges.alias("ranges"), since.alias("since"), degrees.alias("degrees"))
