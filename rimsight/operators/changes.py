"""Snapshot differences, summaries, appends and searchable views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimsight.operators.ranking import number_rows
from rimsight.session import hold


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({f"_{k}": F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys})


def missing_from(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the other table; a missing part equals ''."""
    names = [f"_{k}" for k in keys]
    known = _keys(other, keys).select(*names).distinct()
    return _keys(rows, keys).join(known, names, "left_anti").select(*rows.columns)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows only in the new snapshot as added, only in the old as removed."""
    added = missing_from(new, old, keys).withColumn("change", F.lit("added"))
    removed = missing_from(old, new, keys).withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def change_summary(diff: DataFrame, label: Column, order: Sequence[str], what: str, shown: int = 5) -> DataFrame:
    """One line: the first few added names, how many more, and how many removed."""
    held = hold(diff)
    counts = held.agg(
        F.count_if(F.col("change") == "added").alias("added"), F.count_if(F.col("change") == "removed").alias("removed")
    )
    first = held.where("change = 'added'").orderBy(*order).limit(shown)
    # at most ``shown`` rows
    marks = F.array_sort(F.collect_list(F.struct(*order, label.alias("_label"))))
    names = first.agg(F.array_join(F.transform(marks, lambda s: s["_label"]), ", ").alias("names"))
    more = F.when(F.col("added") > shown, F.format_string(" + %d more", F.col("added") - shown)).otherwise("")
    parts = F.array_compact(
        F.array(
            F.when(F.col("added") > 0, F.concat(F.lit(f"{what} added: "), "names", more)),
            F.when(F.col("removed") > 0, F.format_string(f"%d {what} removed", "removed")),
        )
    )
    joined = counts.crossJoin(F.broadcast(names))
    line = F.when(F.size(parts) == 0, "no new entries").otherwise(F.array_join(parts, "; "))
    return joined.select("added", "removed", line.alias("summary"))


def symmetric_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values in exactly one of the two, with the side."""
    a = left.select(column).distinct().withColumn("_l", F.lit(True))
    b = right.select(column).distinct().withColumn("_r", F.lit(True))
    both = a.join(b, column, "full")
    side = F.when(F.col("_r").isNull(), "left").otherwise("right")
    return both.where(F.col("_l").isNull() | F.col("_r").isNull()).select(column, side.alias("side"))


def append_missing(existing: DataFrame, seen: DataFrame, name: str, defaults: dict[str, Column]) -> DataFrame:
    """Existing rows plus a default row for each trimmed, non-empty name not yet listed."""
    wanted = seen.select(F.trim(name).alias(name)).where(F.col(name) != "").distinct()
    listed = existing.select(F.trim(name).alias(name)).distinct()
    new = wanted.join(listed, name, "left_anti").withColumns(defaults)
    return existing.unionByName(new.select(*existing.columns))


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Rows numbered into batches of a fixed size."""
    numbered = number_rows(df, [F.col(order)], "_n")
    return numbered.withColumn("batch", F.floor((F.col("_n") - 1) / size)).drop("_n")


def search(df: DataFrame, text: str, fields: Sequence[str], facets: dict[str, str | None], any_case: Sequence[str] = ()) -> DataFrame:
    """Rows whose joined fields contain the text, any case, and whose facets match."""
    out = df
    for column, wanted in facets.items():
        if wanted:
            value = F.upper(F.coalesce(column, F.lit(""))) if column in any_case else F.col(column)
            out = out.where(value == (wanted.upper() if column in any_case else wanted))
    if text:
        hay = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))
        out = out.where(hay.contains(text.lower()))
    return out


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted different non-empty values."""
    return df.where(F.col(column) != "").select(column).distinct().orderBy(column)


def pick_rows(
    rows: DataFrame, name: str, names: Sequence[str] = (), shuffle_by: Column | None = None, limit: int | None = None, demo: bool = False
) -> DataFrame:
    """Name list, then shuffle, then demo (five rows) or limit."""
    out = rows.where(F.col(name).isin(*names)) if names else rows
    if shuffle_by is not None:
        out = out.orderBy(shuffle_by)
    cap = 5 if demo else limit
    return out if cap is None else out.limit(cap)
