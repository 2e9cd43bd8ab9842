"""Lookups: cascades, composite keys, overrides, strict matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimsight.operators.keyed import first_per_key, last_per_key


def cascade(positions: DataFrame, colleges: DataFrame, teams: DataFrame) -> DataFrame:
    """Team data by id, else by name, else the original name.

    ``colleges``: college, ncaa_id, college_clean, category, ord (first row
    wins). ``teams``: ncaa_id, team, team_state, conference, division.
    """
    named = first_per_key(
        colleges.select(
            "college",
            F.col("ncaa_id").alias("team_id"),
            F.col("college_clean").alias("_clean"),
            F.col("category").alias("_category"),
            "ord",
        ),
        ["college"],
        [F.col("ord")],
    ).drop("ord")
    known = colleges.where(F.col("ncaa_id").isNotNull())
    by_id = first_per_key(
        known.select(F.col("ncaa_id").alias("team_id"), F.col("category").alias("_id_category"), "ord"),
        ["team_id"],
        [F.col("ord")],
    ).drop("ord")
    team = teams.select(F.col("ncaa_id").alias("team_id"), F.col("team").alias("_team"), "team_state", "conference", "division")
    joined = positions.join(named, "college", "left").join(by_id, "team_id", "left").join(team, "team_id", "left")
    blank = F.lit("")
    by_team = F.col("_team").isNotNull() & (F.col("_team") != "")
    clean = F.coalesce(F.nullif(F.col("_team"), blank), F.nullif(F.col("_clean"), blank), F.col("college"))
    category = F.when(by_team, F.coalesce("_id_category", blank)).otherwise(F.coalesce("_category", blank))
    return joined.select(
        *positions.columns,
        "team_id",
        clean.alias("college_clean"),
        category.alias("category"),
        *[F.coalesce(c, blank).alias(c) for c in ("team_state", "conference", "division")],
    )


def composite_lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Value of the last table row equal on all keys, missing matching missing; '' if none."""
    last = last_per_key(table.select(*keys, value, order), list(keys), [F.col(order)]).drop(order)
    renamed = last.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = rows.join(renamed, condition, "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumn(value, F.coalesce(value, F.lit("")))


def attribute_map(rows: DataFrame, table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Attribute by name, the last row per name wins."""
    last = last_per_key(table.where(F.col(key) != "").select(key, value, order), [key], [F.col(order)])
    return rows.join(last.drop(order), key, "left")


def match_report(rows: DataFrame, value: str) -> DataFrame:
    known = F.count_if(F.col(value).isNotNull())
    table = rows.agg(F.count(F.lit(1)).alias("total"), known.alias("matched"))
    return table.withColumn("unmatched", F.col("total") - F.col("matched")).withColumn(
        "matched_pct", F.try_divide("matched", "total") * 100
    )


def label_counts(rows: DataFrame, value: str) -> DataFrame:
    """Rows per label, missing as 'None'."""
    return rows.groupBy(F.coalesce(value, F.lit("None")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def override(rows: DataFrame, moves: DataFrame, key: str, value: str, new: str) -> DataFrame:
    return rows.join(moves.select(key, new), key, "left").withColumn(value, F.coalesce(new, value)).drop(new)


def override_changes(rows: DataFrame, moves: DataFrame, key: str, value: str, new: str) -> DataFrame:
    """Rows whose value would change."""
    joined = rows.join(moves.select(key, new), key).where(F.col(value) != F.col(new))
    return joined.select(key, F.col(value).alias("old"), F.col(new).alias("new"))


def by_normal_name(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str) -> DataFrame:
    """Join on a normalised-name key."""
    a = left.withColumn("_key", left_key)
    b = right.withColumn("_key", right_key)
    return a.join(b, "_key", how).drop("_key")


def strict_sides(games: DataFrame, history: DataFrame, order: str) -> DataFrame:
    """Region and seed of both teams by (year, team); a miss fails the job that reads it, naming year and team."""
    first = first_per_key(history, ["year", "team_id"], [F.col(order)]).drop(order).withColumn("_known", F.lit(True))
    out = games
    for side in ("team_1", "team_2"):
        named = first.select(
            "year", F.col("team_id").alias(f"{side}_id"), F.struct("region", "seed").alias("_found"), "_known"
        )
        missing = F.raise_error(F.concat(F.lit("no history for "), F.to_json(F.struct("year", f"{side}_id"))))
        joined = out.join(named, ["year", f"{side}_id"], "left")
        found = F.when(F.col("_known"), F.col("_found")).otherwise(missing.cast(joined.schema["_found"].dataType))
        out = joined.withColumn("_found", found).select(
            *out.columns, F.col("_found.region").alias(f"{side}_region"), F.col("_found.seed").alias(f"{side}_seed")
        )
    return out


def side_by_containment(games: DataFrame, team: str = "team", team_id: str = "team_id") -> DataFrame:
    """Directory id on the side whose name contains the team's, home first."""
    home = F.col("home").contains(F.col(team))
    visitor = ~home & F.col("visitor").contains(F.col(team))
    return games.withColumn("home_team_id", F.when(home, F.col(team_id))).withColumn(
        "visiting_team_id", F.when(visitor, F.col(team_id))
    )


def resume(bios: DataFrame, prior: DataFrame, keys: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """New rows with the arrays already extracted for them, else empty arrays."""
    joined = bios.join(prior.select(*keys, *arrays), list(keys), "left")
    return joined.withColumns({a: F.coalesce(F.col(a), F.array().cast(prior.schema[a].dataType)) for a in arrays})


def unprocessed(rows: DataFrame, array: str) -> DataFrame:
    """Rows whose array is empty or missing."""
    return rows.where(F.coalesce(F.size(array), F.lit(0)) <= 0)


def domain_overlap(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Names in both tables with both counts."""
    a = left.groupBy(name).agg(F.count(F.lit(1)).alias("position_count"))
    b = right.groupBy(name).agg(F.count(F.lit(1)).alias("education_count"))
    return a.join(b, name)
