"""Box-score features, opponent-adjusted residuals and their reliability.

Team boxes have two rows per game: game_id, team_id, team_short_display_name,
team_winner, team_score and the counted statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OFFENSE = ["efg_pct", "tov_pct", "orb_pct", "ft_rate", "three_par"]
DEFENSE = ["opp_efg_pct", "opp_tov_pct", "drb_pct", "opp_ft_rate"]
FEATURES = OFFENSE + DEFENSE
RESIDUALS = [f"{f}_resid" for f in FEATURES]

OPPONENT = {
    "team_id": "team_id_opp",
    "team_score": "opp_score",
    "field_goals_made": "opp_fgm",
    "field_goals_attempted": "opp_fga",
    "three_point_field_goals_made": "opp_3pm",
    "three_point_field_goals_attempted": "opp_3pa",
    "free_throws_made": "opp_ftm",
    "free_throws_attempted": "opp_fta",
    "offensive_rebounds": "opp_orb",
    "defensive_rebounds": "opp_drb",
    "turnovers": "opp_to",
}


def with_opponent(box: DataFrame) -> DataFrame:
    """Each side with the other side's numbers."""
    other = box.select("game_id", *[F.col(c).alias(o) for c, o in OPPONENT.items()])
    return box.join(other, "game_id").where(F.col("team_id") != F.col("team_id_opp"))


def _finite(column: str) -> Column:
    c = F.col(column)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def game_features(games: DataFrame) -> DataFrame:
    """Nine factors, scoring shares and rates; rows without them are dropped."""
    c, div = F.col, F.try_divide
    made, tried = c("field_goals_made"), c("field_goals_attempted")
    built = games.withColumns(
        {
            "efg_pct": div(made + 0.5 * c("three_point_field_goals_made"), tried),
            "tov_pct": div(c("turnovers"), tried + 0.44 * c("free_throws_attempted") + c("turnovers")),
            "orb_pct": div(c("offensive_rebounds"), c("offensive_rebounds") + c("opp_drb")),
            "ft_rate": div(c("free_throws_made"), tried),
            "three_par": div(c("three_point_field_goals_attempted"), tried),
            "opp_efg_pct": div(c("opp_fgm") + 0.5 * c("opp_3pm"), c("opp_fga")),
            "opp_tov_pct": div(c("opp_to"), c("opp_fga") + 0.44 * c("opp_fta") + c("opp_to")),
            "drb_pct": div(c("defensive_rebounds"), c("defensive_rebounds") + c("opp_orb")),
            "opp_ft_rate": div(c("opp_ftm"), c("opp_fga")),
            "paint_share": div(c("points_in_paint").try_cast("double"), c("team_score")),
            "fastbreak_share": div(c("fast_break_points").try_cast("double"), c("team_score")),
            "ast_rate": div(c("assists"), made),
            "ft_attempt_rate": div(c("free_throws_attempted"), tried),
            "ft_accuracy": F.when(
                c("free_throws_attempted") > 0, div(c("free_throws_made"), c("free_throws_attempted"))
            ),
        }
    )
    finite = reduce(lambda a, b: a & b, [_finite(f) for f in FEATURES])
    return built.where((tried > 0) & (c("opp_fga") > 0) & finite)


def closeness(margin: Column, scale: float) -> Column:
    """1 / (1 + margin / scale); an infinite scale weighs all games alike."""
    if scale == float("inf"):
        return F.lit(1.0)
    return 1 / (1 + margin / scale)


def season_averages(features: DataFrame) -> DataFrame:
    """Season means of what each team does and what it allows, in one pass."""
    allowed = F.avg(F.try_divide("opp_3pa", "opp_fga")).alias("avg_opp_three_par")
    return features.groupBy("team_id").agg(
        *[F.avg(f).alias(f"avg_{f}") for f in FEATURES], allowed, F.count(F.lit(1)).alias("n_games")
    )


def with_season_averages(wins: DataFrame, averages: DataFrame) -> DataFrame:
    """Opponent's allowed and own averages, and the team's own rebound average."""
    allowed = ["efg_pct", "tov_pct", "ft_rate", "three_par"]
    opponent = averages.select(
        F.col("team_id").alias("team_id_opp"),
        *[F.col(f"avg_opp_{f}").alias(f"opp_avg_opp_{f}") for f in allowed],
        F.col("avg_drb_pct").alias("opp_avg_drb_pct"),
        *[F.col(f"avg_{f}").alias(f"opp_avg_{f}") for f in OFFENSE],
    )
    own = averages.select("team_id", F.col("avg_drb_pct").alias("own_avg_drb_pct"))
    return wins.join(opponent, "team_id_opp", "left").join(own, "team_id", "left")


def residuals(joined: DataFrame) -> DataFrame:
    """Features less what the opponent usually allows or usually does."""
    c = F.col
    return joined.withColumns(
        {
            "efg_pct_resid": c("efg_pct") - c("opp_avg_opp_efg_pct"),
            "tov_pct_resid": c("tov_pct") - c("opp_avg_opp_tov_pct"),
            "orb_pct_resid": c("orb_pct") - (1 - c("opp_avg_drb_pct")),
            "ft_rate_resid": c("ft_rate") - c("opp_avg_opp_ft_rate"),
            "three_par_resid": c("three_par") - c("opp_avg_opp_three_par"),
            "opp_efg_pct_resid": c("opp_efg_pct") - c("opp_avg_efg_pct"),
            "opp_tov_pct_resid": c("opp_tov_pct") - c("opp_avg_tov_pct"),
            "drb_pct_resid": c("drb_pct") - c("own_avg_drb_pct"),
            "opp_ft_rate_resid": c("opp_ft_rate") - c("opp_avg_ft_rate"),
        }
    )


def win_features(features: DataFrame, scale: float = 10.0, averages: DataFrame | None = None) -> DataFrame:
    """Wins only, with margin, closeness weight and residuals; season averages that are kept already can be given."""
    wins = features.where("team_winner").withColumn("margin", F.col("team_score") - F.col("opp_score"))
    wins = wins.withColumn("closeness_weight", closeness(F.col("margin"), scale))
    return residuals(with_season_averages(wins, season_averages(features) if averages is None else averages))


def enough_wins(wins: DataFrame, minimum: int = 20) -> DataFrame:
    return (
        wins.groupBy("team_id", "team_short_display_name")
        .agg(F.count(F.lit(1)).alias("n_wins"))
        .where(F.col("n_wins") >= minimum)
    )


def eligible(wins: DataFrame, minimum: int = 20, teams: DataFrame | None = None) -> DataFrame:
    """Wins of teams with enough of them; what ``enough_wins`` gives can be given if it is kept already."""
    teams = enough_wins(wins, minimum) if teams is None else teams
    return wins.join(teams.select("team_id"), "team_id", "left_semi")


def to_long(wide: DataFrame, keys: Sequence[str], pieces: dict[str, Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One row per feature from one wide row; ``pieces`` maps a feature to its columns."""
    rows = [
        F.struct(F.lit(f).alias("feature"), *[c.alias(n) for c, n in zip(cols, names)]) for f, cols in pieces.items()
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def residual_summary(wins: DataFrame, features: Sequence[str] = RESIDUALS) -> DataFrame:
    """Mean and sample deviation of each feature, four places."""
    wide = wins.agg(
        *[F.avg(f).alias(f"{f}__mean") for f in features], *[F.stddev_samp(f).alias(f"{f}__sd") for f in features]
    )
    pieces = {f: [F.round(f"{f}__mean", 4), F.round(f"{f}__sd", 4)] for f in features}
    return to_long(wide, [], pieces, ["mean", "sd"])


def icc_table(wins: DataFrame, features: Sequence[str], group: str = "team_id") -> DataFrame:
    """One-way ICC(1) of each feature and its square root as weight.

    All features are aggregated per group in one pass without unpivoting the
    games; only the group rows are made long. Null under three groups.
    """
    per_group = wins.groupBy(group).agg(
        *[F.count(f).alias(f"{f}__n") for f in features],
        *[F.avg(f).alias(f"{f}__m") for f in features],
        *[F.var_pop(f).alias(f"{f}__v") for f in features],
    )
    pieces = {f: [F.col(f"{f}__n"), F.col(f"{f}__m"), F.col(f"{f}__v") * F.col(f"{f}__n")] for f in features}
    long = to_long(per_group, [group], pieces, ["n", "m", "ss"]).where("n > 0")
    # grand means: one row per feature of the list above, so the broadcast is bounded
    grand = long.groupBy("feature").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    sums = (
        long.join(F.broadcast(grand), "feature")
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.sum("n").alias("N"),
            F.sum(F.col("n") * F.col("n")).alias("n2"),
            F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2)).alias("ssb"),
            F.sum("ss").alias("ssw"),
        )
    )
    msb = F.col("ssb") / (F.col("k") - 1)
    msw = F.try_divide(F.col("ssw"), F.col("N") - F.col("k"))
    k0 = (F.col("N") - F.col("n2") / F.col("N")) / (F.col("k") - 1)
    icc = F.when(F.col("k") >= 3, F.greatest(F.lit(0.0), F.try_divide(msb - msw, msb + (k0 - 1) * msw)))
    return sums.select("feature", icc.alias("icc"), F.sqrt(icc).alias("weight"))


def win_share(team_wins: DataFrame, features: DataFrame) -> DataFrame:
    """Wins over all games with valid features."""
    played = features.groupBy("team_id").agg(F.count(F.lit(1)).alias("n_games"))
    return team_wins.join(played, "team_id", "left").withColumn("win_pct", F.col("n_wins") / F.col("n_games"))
