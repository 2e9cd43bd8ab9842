"""Named queries and the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

PLACES = 6
# Rounding moved off the middle between two results, where most natural ties lie (halves, quarters, short decimals):
# sums taken in another order differ in their last bits, and must not round to different sides there.
SHIFT = 0.1353352832 * 10**-PLACES


def plain(df: DataFrame) -> DataFrame:
    """Doubles to six places (see SHIFT) and whole numbers to long, as the SQL side gives them."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double") + F.lit(SHIFT), PLACES) + F.lit(0.0)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("long")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a query; ``doubles`` names the SQL columns to round."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = rounded(sql, doubles.split())
        return build

    return register


def rounded(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql
    swaps = ", ".join(f"round(CAST({c} AS DOUBLE) + {SHIFT!r}::DOUBLE, {PLACES}) + 0.0::DOUBLE AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({swaps}) FROM ({sql})"
