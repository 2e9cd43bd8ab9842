"""Writers with fixed fields, JSON records and child tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimsight.operators.keyed import last_per_key


def write_csv(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """CSV with a header and exactly the given fields in order."""
    df.select(*fields).write.mode("overwrite").csv(path, header=True, escape='"')


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, other alphabets kept as they are."""
    df.write.mode("overwrite").json(path)


def child_tables(docs: DataFrame, order: str) -> dict[str, DataFrame]:
    """Coaches and their positions, education and playing career, keyed by url.

    The last document per url replaces earlier ones, children with it.
    """
    latest = last_per_key(docs, ["url"], [F.col(order)])
    out = {"coaches": latest.drop("positions", "education", "playing_career", order)}
    for name in ("positions", "education", "playing_career"):
        out[name] = latest.select(F.col("url").alias("coach_url"), F.inline(name))
    return out


def write_child_tables(docs: DataFrame, order: str, folder: str) -> None:
    for name, df in child_tables(docs, order).items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
