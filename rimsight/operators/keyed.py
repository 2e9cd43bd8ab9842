"""One row per key, and keyed merges, as combinable aggregates.

``min_by``/``max_by`` combine before the shuffle, so a key that holds a third
of all rows still sends one row per task; a ``row_number`` window would not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column], chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        chooser(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("_p")
    )
    return picked.select(*[F.col(c) if c in keys else F.col(f"_p.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``; nulls in the order sort first."""
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last row of each key in ``order``."""
    return _pick(df, keys, order, F.max_by)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Union of both sides, one row per key, the latest batch wins."""
    return last_per_key(current.unionByName(incoming), keys, [F.col(order)])


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Text id of a whole row, for tables without a natural key."""
    return F.sha1(F.to_json(F.struct(*columns)))
