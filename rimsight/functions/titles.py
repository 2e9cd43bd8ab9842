"""Titles and school names to standard categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rimsight.functions.strings import chain, squish, strip

# fixed values: ordered patterns on the cleaned lower-case title, first match wins
TITLE_PATTERNS = [
    ("interim.*head.*coach", "Interim Head Coach"),
    ("head.*coach", "Head Coach"),
    ("acting.*head.*coach", "Interim Head Coach"),
    ("associate.*head", "Associate Head Coach"),
    ("associate.*coach", "Associate Head Coach"),
    ("lead.*assistant", "Lead Assistant Coach"),
    ("head.*assistant", "Lead Assistant Coach"),
    ("assistant.*head", "Assistant Head Coach"),
    ("recruiting.*coordinator", "Recruiting Coordinator"),
    ("offensive.*coordinator", "Offensive Coordinator"),
    ("defensive.*coordinator", "Defensive Coordinator"),
    ("director.*basketball.*operations", "Director of Basketball Operations"),
    ("director.*operations", "Director of Basketball Operations"),
    ("director.*player.*development", "Director of Player Development"),
    ("director.*recruiting", "Director of Recruiting"),
    ("player.*development", "Director of Player Development"),
    ("assistant.*coach", "Assistant Coach"),
    ("graduate.*assistant", "Graduate Assistant"),
    ("graduate.*manager", "Graduate Assistant"),
    ("volunteer.*assistant", "Volunteer Assistant"),
    ("video.*coordinator", "Video Coordinator"),
    ("strength.*conditioning", "Strength and Conditioning Coach"),
    ("athletic.*trainer", "Athletic Trainer"),
    ("student.*manager", "Student Manager"),
    ("student.*assistant", "Student Assistant"),
    ("team.*manager", "Manager"),
    ("^manager$", "Manager"),
    ("administrative.*assistant", "Administrative Assistant"),
    ("coach", "Assistant Coach"),
]
# fixed values: cleaning before the patterns
TITLE_CLEANING = [
    ("the .+ (head|assistant|associate)", "$1"),
    (" */ *", " / "),
    (" *& *| and ", " / "),
    (" *, *", " / "),
]
ROLE_SEPARATOR = " */ *| *& *| and |, *"

# fixed values: ordered school patterns (any case), first match wins
SCHOOL_PATTERNS = [
    ("^LSU$", "Louisiana State University"),
    ("^UCLA$", "University of California, Los Angeles"),
    ("^USC$", "University of Southern California"),
    ("^UConn$", "University of Connecticut"),
    ("^UCF$", "University of Central Florida"),
    ("^UAB$", "University of Alabama at Birmingham"),
    ("^SMU$", "Southern Methodist University"),
    ("^TCU$", "Texas Christian University"),
    ("^BYU$", "Brigham Young University"),
    ("^Texas A&M$|^Texas A & M$", "Texas A&M University"),
    ("Texas A&M.*Commerce|A&M.*Commerce", "Texas A&M University-Commerce"),
    ("Texas A&M.*Corpus Christi", "Texas A&M University-Corpus Christi"),
    ("Texas A&M.*Kingsville", "Texas A&M University-Kingsville"),
    ("Texas A&M.*International", "Texas A&M University-International"),
    ("^University of Iowa$", "University of Iowa"),
    ("^Iowa$", "University of Iowa"),
    ("^Iowa State|Iowa State University", "Iowa State University"),
    ("^Northern Iowa|University of Northern Iowa", "University of Northern Iowa"),
    ("^Connecticut$|^University of Connecticut$|^UConn$", "University of Connecticut"),
    ("Central Connecticut", "Central Connecticut State University"),
    ("Southern Connecticut", "Southern Connecticut State University"),
    (r"^Saint Joseph's|^St\. Joseph's", "Saint Joseph's University"),
    (r"^Saint Mary's \(CA\)|^St\. Mary's \(CA\)", "Saint Mary's College of California"),
    (r"^Saint Louis|^St\. Louis", "Saint Louis University"),
    ("^Alabama$|^University of Alabama$", "University of Alabama"),
    ("Alabama State", "Alabama State University"),
    ("Alabama A&M|Alabama A & M", "Alabama A&M University"),
    ("Alabama.*Birmingham|UAB", "University of Alabama at Birmingham"),
    ("Alabama.*Huntsville", "University of Alabama in Huntsville"),
    ("^Cal State.*Bakersfield|Cal State - Bakersfield", "California State University, Bakersfield"),
    ("^Cal State.*Fullerton", "California State University, Fullerton"),
    ("^Cal State.*Northridge|CSUN", "California State University, Northridge"),
    ("AAU|STORM", "NON_NCAA_AAU"),
    ("High School$", "NON_NCAA_HIGH_SCHOOL"),
    ("^NBA$|^WNBA$|Sun$|Mercury$|Lynx$", "NON_NCAA_PROFESSIONAL"),
]
# fixed values
NON_NCAA = ["AAU", "High School", "Academy", "STORM", "Elite", "NBA", "WNBA", "Sun$", "Mercury$", "Bulls"]
ABBREVIATIONS = ["LSU", "USC", "UCLA", "UCF", "UAB", "FIU", "FAU", "UTEP", "UNLV", "SMU", "TCU", "BYU"]
FULL_NAMES = ["Louisiana State", "Southern California", "California, Los Angeles"]


def standard_title(title: Column) -> Column:
    """Category of a raw title; null stays null, anything unmatched is Other."""
    clean = chain(F.lower(title), TITLE_CLEANING)
    out = F.when(title.isNull(), F.lit(None).cast("string"))
    for pattern, category in TITLE_PATTERNS:
        out = out.when(clean.rlike(pattern), category)
    return out.otherwise("Other")


def role_components(title: Column) -> Column:
    """Roles of a compound title, blanks dropped."""
    return F.filter(F.transform(F.split(title, ROLE_SEPARATOR), strip), lambda r: r != "")


def standard_school(school: Column) -> Column:
    """Canonical name by the first matching pattern, else blanks squeezed."""
    out = F.when(school.isNull(), F.lit(None).cast("string"))
    for pattern, name in SCHOOL_PATTERNS:
        out = out.when(school.rlike(f"(?i){pattern}"), name)
    return out.otherwise(strip(F.regexp_replace(school, " +", " ")))


def non_ncaa(school: Column) -> Column:
    return school.rlike("|".join(NON_NCAA))


def separator_flags(title: Column) -> dict[str, Column]:
    return {
        "has_slash": title.contains("/"),
        "has_ampersand": title.contains("&"),
        "has_and": title.contains(" and "),
        "has_comma": title.contains(","),
    }


def sport_flags(title: Column, sport: str = "Women's Basketball") -> dict[str, Column]:
    prefix, suffix = title.startswith(sport), title.endswith(sport)
    return {"prefix": prefix, "suffix": suffix, "inline": title.contains(sport) & ~prefix & ~suffix}


def role_of_post(text: Column) -> Column:
    """'hired' when the post names a hire, else 'departed'."""
    return F.when(text.rlike(r"(?i)\b(hired|named)\b"), "hired").otherwise("departed")


def school_and_conference(heading: Column) -> tuple[Column, Column]:
    """``School (Conference)`` apart; conference '' when absent."""
    text, pattern = strip(heading), r"^(.+?)\s*\(([^)]+)\)\s*$"
    hit = text.rlike(pattern)
    school = F.when(hit, strip(F.regexp_extract(text, pattern, 1))).otherwise(text)
    return school, F.when(hit, strip(F.regexp_extract(text, pattern, 2))).otherwise("")


def external_link(html: Column, blog: str) -> Column:
    """First link of a fragment that does not point to the blog itself."""
    links = F.regexp_extract_all(html, F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return F.get(F.filter(links, lambda u: ~u.contains(blog)), F.lit(0))


def transfer_history(text: Column) -> Column:
    found = F.regexp_extract(text, r"(?is)transfer history\s*:\s*(.+)", 1)
    return F.when(found != "", squish(found))
