"""Pieces of stored HTML as column expressions; no parser leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rimsight.functions.strings import squish, strip

# fixed values: character entities decoded in text, the ampersand last
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
HIDDEN_PARTS = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head[^>]*>.*?</head>|<nav[^>]*>.*?</nav>"


def class_pattern(name: str) -> str:
    """Attribute pattern for one class among others."""
    return rf'class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"'


def decode(text: Column) -> Column:
    for entity, plain in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def text_of(fragment: Column, separator: str = "") -> Column:
    """Text without tags."""
    return decode(F.regexp_replace(fragment, r"(?s)<[^>]*>", separator))


def visible_text(html: Column) -> Column:
    """Readable text of a page: head, navigation, scripts, styles and comments removed."""
    return squish(text_of(F.regexp_replace(html, HIDDEN_PARTS, " "), " "))


def _up_to_end(tag: str) -> str:
    """Pattern of all before a tag's first end, in runs without ``<`` and never tried again."""
    return rf"(?:[^<]++|<(?!/{tag}>))*+"


def blocks(html: Column, *tags: str) -> Column:
    """Whole elements of the given tags in document order."""
    alternatives = "|".join(rf"{t}(?:\s[^>]*)?>{_up_to_end(t)}</{t}>" for t in tags)
    return F.regexp_extract_all(html, F.lit(f"(?is)(<(?:{alternatives}))"), F.lit(1))


def inner(html: Column, tag: str) -> Column:
    """Contents of all elements of one tag."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>({_up_to_end(tag)})</{tag}>"), F.lit(1))


def first_link(fragment: Column) -> Column:
    return F.regexp_extract(fragment, r'(?is)<a\s[^>]*href="([^"]*)"', 1)


def headings(html: Column) -> Column:
    """Texts of h1, h2 and title elements."""
    return F.transform(F.flatten(F.array(inner(html, "h1"), inner(html, "h2"), inner(html, "title"))), lambda t: strip(text_of(t)))


def has_class(html: Column, tag: str, name: str) -> Column:
    return html.rlike(rf"(?is)<{tag}\s[^>]*{class_pattern(name)}")
