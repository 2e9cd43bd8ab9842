"""Column expressions shared by the operators that stay in DataFrame functions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of the line and word rules, as characters and for patterns.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]+"
# A word once A-Z are lower case: a-z, 0-9 and everything outside ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
PLAIN_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` where the text is plain ASCII, which is faster."""
    swapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(swapped)


NO_ID = -(2**63)


def doc_key(column: str) -> Column:
    """The id as a sortable number: a null id counts as one document before all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like those wanted that no column of ``df`` has (columns clash without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
