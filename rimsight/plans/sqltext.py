"""Helpers that write the SQL side of text queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(key: str, values: Sequence[str]) -> Column:
    """One of the values by the row's key, so every row has a text of its own kind."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def pick_sql(key: str, values: Sequence[str]) -> str:
    return f"list_extract([{', '.join(quoted(v) for v in values)}], CAST({key} % {len(values)} + 1 AS INT))"


def chain_sql(expr: str, steps: Sequence[tuple[str, str]], flags: str = "g") -> str:
    for pattern, replacement in steps:
        back = replacement.replace("$1", "\\1")
        expr = f"regexp_replace({expr}, {quoted(pattern)}, {quoted(back)}, '{flags}')"
    return expr


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def squish_sql(expr: str) -> str:
    return strip_sql(f"regexp_replace({expr}, '\\s+', ' ', 'g')")


def case_sql(expr: str, table: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items())
    return f"CASE {expr} {arms} ELSE {default} END"


def first_sql(expr: str, patterns: Sequence[str], flags: str = "") -> str:
    arms = " ".join(
        f"WHEN regexp_matches({expr}, {quoted(flags + p)}) THEN regexp_extract({expr}, {quoted(flags + p)}, 1)" for p in patterns
    )
    return f"CASE {arms} ELSE '' END"


def ordered_sql(expr: str, patterns: Sequence[tuple[str, str]], default: str, flags: str = "") -> str:
    arms = " ".join(f"WHEN regexp_matches({expr}, {quoted(flags + p)}) THEN {quoted(v)}" for p, v in patterns)
    return f"CASE {arms} ELSE {default} END"
