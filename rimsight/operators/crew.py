"""Statistics of officials and of the pairs they form in a crew.

Games have: game_id, season, home, visitor, officials (array of names),
home_fouls, visitor_fouls, home_technicals, visitor_technicals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimsight.operators import ranking
from rimsight.session import hold


def with_totals(games: DataFrame) -> DataFrame:
    return games.withColumn("total_fouls", F.col("home_fouls") + F.col("visitor_fouls"))


def clean_crew(games: DataFrame) -> DataFrame:
    """Names trimmed once at load, so membership and pairs agree."""
    return games.withColumn("officials", F.transform("officials", lambda n: F.trim(n)))


def pair_signature(first: Column, second: Column) -> Column:
    """Both names trimmed, in alphabetical order, joined by ' & '."""
    return F.array_join(F.array_sort(F.array(F.trim(first), F.trim(second))), " & ")


def short_pair_name(signature: Column) -> Column:
    """Last words of both names, for display."""
    names = F.split(signature, " & ")
    last = F.transform(names, lambda n: F.element_at(F.split(F.trim(n), r"\s+"), -1))
    return F.array_join(last, " & ")


def crew_members(games: DataFrame) -> DataFrame:
    """One row per game and different non-blank official."""
    return games.withColumn("official", F.explode(F.array_distinct("officials"))).where(F.trim("official") != "")


def crew_pairs(games: DataFrame) -> DataFrame:
    """Every 2-combination of each game's crew, position order, as sorted names.

    The two explodes stream: no row ever holds the quadratic list of pairs.
    """
    firsts = games.select("*", F.posexplode("officials").alias("_i", "_a"))
    seconds = firsts.withColumn(
        "_b", F.explode(F.slice("officials", F.col("_i") + 2, F.size("officials")))
    )
    a, b = F.trim("_a"), F.trim("_b")
    return seconds.select(
        *[c for c in games.columns if c != "officials"],
        F.least(a, b).alias("official_1"),
        F.greatest(a, b).alias("official_2"),
    )


def dealt_pairs(games: DataFrame, tasks: int | None) -> DataFrame:
    """The pairs of all crews, each pair's games in one of so many tasks (left to Spark without a number).

    Few rows of a pair meet before the shuffle, so counting there would only hold a task's pairs twice.
    """
    pairs = crew_pairs(games)
    return pairs if tasks is None else pairs.repartition(tasks, "official_1", "official_2")


def _signature() -> Column:
    return F.concat_ws(" & ", "official_1", "official_2").alias("partnership_signature")


def foul_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("games_worked"),
        F.avg("total_fouls").alias("avg_fouls_per_game"),
        F.min("total_fouls").alias("min_fouls"),
        F.max("total_fouls").alias("max_fouls"),
        F.stddev_samp("total_fouls").alias("std_fouls"),
        F.avg("home_fouls").alias("avg_home_fouls"),
        F.avg("visitor_fouls").alias("avg_visitor_fouls"),
        (F.avg("home_fouls") - F.avg("visitor_fouls")).alias("home_visitor_diff"),
        F.avg(F.col("home_technicals") + F.col("visitor_technicals")).alias("avg_technicals"),
    ]


def _scored(profile: DataFrame, flat: float | None) -> DataFrame:
    held = hold(profile)
    scored = ranking.z_score(held, "avg_fouls_per_game", "z_score", flat)
    return ranking.percentile(scored, "avg_fouls_per_game", "percentile")


def official_profile(games: DataFrame, min_games: int = 5) -> DataFrame:
    members = crew_members(with_totals(games))
    profile = members.groupBy("official").agg(*foul_measures()).where(F.col("games_worked") >= min_games)
    return _scored(profile, None)


def games_between(games: DataFrame, teams: Sequence[str]) -> DataFrame:
    """Games in which both sides are in the list."""
    return games.where(F.col("home").isin(*teams) & F.col("visitor").isin(*teams))


def games_of(games: DataFrame, *officials: str) -> DataFrame:
    """Games every given official worked."""
    for name in officials:
        games = games.where(F.array_contains("officials", name))
    return games


def partner_effect(games: DataFrame, official: str, min_games: int = 3) -> DataFrame:
    """Mean fouls with each partner against the official's own mean."""
    own = games_of(with_totals(games), official)
    mean = own.agg(F.avg("total_fouls").alias("_own"))
    partners = own.withColumn("partner", F.explode(F.filter("officials", lambda n: n != official)))
    stats = partners.groupBy("partner").agg(
        F.count("game_id").alias("games"), F.avg("total_fouls").alias("avg_fouls")
    )
    return (
        stats.where(F.col("games") >= min_games)
        .crossJoin(F.broadcast(mean))
        .withColumn("diff_from_avg", F.col("avg_fouls") - F.col("_own"))
        .drop("_own")
    )


def pair_profile(games: DataFrame, min_games: int = 5, by_season: bool = False, tasks: int | None = None) -> DataFrame:
    """Foul statistics per pair; scores run over all rows, seasons together."""
    pairs = dealt_pairs(with_totals(games), tasks)
    season = F.col("season").cast("string") if by_season else F.lit("All Seasons")
    keys = [season.alias("season"), "official_1", "official_2"]
    profile = pairs.groupBy(*keys).agg(*foul_measures()).where(F.col("games_worked") >= min_games)
    scored = _scored(profile, 0.0)
    return scored.select("season", _signature(), *[c for c in scored.columns if c != "season"])


def pair_counts(games: DataFrame, tasks: int | None = None) -> DataFrame:
    pairs = dealt_pairs(games.select("officials"), tasks)
    return pairs.groupBy("official_1", "official_2").agg(F.count(F.lit(1)).alias("games_together"))


def frequent_pairs(games: DataFrame, top_n: int | None = 20, tasks: int | None = None) -> DataFrame:
    """The pairs with most games together; all of them without a limit."""
    ordered = pair_counts(games, tasks).orderBy(F.desc("games_together"), "official_1", "official_2")
    top = ordered if top_n is None else ordered.limit(top_n)
    return top.select(_signature(), "official_1", "official_2", "games_together")


def individual_means(games: DataFrame) -> DataFrame:
    members = crew_members(clean_crew(with_totals(games)))
    return members.groupBy("official").agg(F.avg("total_fouls").alias("mean_fouls"))


def pair_against_individuals(games: DataFrame, profile: DataFrame) -> DataFrame:
    """Pair mean less the average of both officials' own means."""
    means = individual_means(games)
    one = means.select(F.col("official").alias("official_1"), F.col("mean_fouls").alias("official_1_individual"))
    two = means.select(F.col("official").alias("official_2"), F.col("mean_fouls").alias("official_2_individual"))
    both = (F.col("official_1_individual") + F.col("official_2_individual")) / 2
    return (
        profile.select("official_1", "official_2", "games_worked", "avg_fouls_per_game")
        .join(one, "official_1")
        .join(two, "official_2")
        .select(
            _signature(),
            "games_worked",
            F.col("avg_fouls_per_game").alias("partnership_avg_fouls"),
            both.alias("individual_avg_fouls"),
            (F.col("avg_fouls_per_game") - both).alias("performance_difference"),
            "official_1",
            "official_2",
            "official_1_individual",
            "official_2_individual",
        )
    )


def pair_seasons(games: DataFrame, min_games: int = 3, tasks: int | None = None) -> DataFrame:
    """Per pair and season, only pairs that qualify in more than one season."""
    pairs = dealt_pairs(with_totals(games), tasks)
    seasons = (
        pairs.groupBy("official_1", "official_2", "season")
        .agg(
            F.count(F.lit(1)).alias("games_worked"),
            F.avg("total_fouls").alias("avg_fouls_per_game"),
            F.stddev_samp("total_fouls").alias("std_fouls"),
            (F.avg("home_fouls") - F.avg("visitor_fouls")).alias("home_visitor_diff"),
        )
        .where(F.col("games_worked") >= min_games)
    )
    # one row per pair and season: as many rows per pair as there are seasons
    row = F.struct("season", "games_worked", "avg_fouls_per_game", "std_fouls", "home_visitor_diff")
    listed = (
        seasons.groupBy("official_1", "official_2")
        .agg(F.collect_list(row).alias("rows"))
        .where(F.size("rows") > 1)
    )
    return listed.select(_signature(), "official_1", "official_2", F.inline("rows"))


def pair_trend(seasons: DataFrame) -> DataFrame:
    """First and last season means and the slope between them."""
    trend = seasons.groupBy("partnership_signature", "official_1", "official_2").agg(
        F.count(F.lit(1)).alias("seasons_active"),
        F.sum("games_worked").alias("total_games"),
        F.min_by("avg_fouls_per_game", "season").alias("first_season_avg"),
        F.max_by("avg_fouls_per_game", "season").alias("last_season_avg"),
        F.array_join(F.array_sort(F.collect_list(F.col("season").cast("string"))), ", ").alias("seasons_list"),
    )
    slope = (F.col("last_season_avg") - F.col("first_season_avg")) / (F.col("seasons_active") - 1)
    return trend.withColumn("trend_slope", slope)


def pair_chemistry(games: DataFrame, min_games: int = 8, tasks: int | None = None) -> DataFrame:
    """Variance plus twice the home-visitor imbalance; lower is better, rank 1 best."""
    pairs = dealt_pairs(with_totals(games), tasks)
    scores = (
        pairs.groupBy("official_1", "official_2")
        .agg(
            F.count(F.lit(1)).alias("games_worked"),
            F.avg("total_fouls").alias("avg_fouls"),
            F.var_samp("total_fouls").alias("foul_variance"),
            (F.max("total_fouls") - F.min("total_fouls")).alias("foul_range"),
            F.abs(F.avg("home_fouls") - F.avg("visitor_fouls")).alias("home_visitor_balance"),
            F.stddev_samp("total_fouls").alias("std_fouls"),
        )
        .where(F.col("games_worked") >= min_games)
        .withColumn("chemistry_score", F.col("foul_variance") + F.col("home_visitor_balance") * 2)
    )
    # scores equal to nine places are ties: sums in another order differ past that
    order = [F.round("chemistry_score", 9), F.col("official_1"), F.col("official_2")]
    ranked = ranking.number_rows(scores, order, "chemistry_rank")
    return ranked.select(_signature(), *ranked.columns)


def pair_network(games: DataFrame, min_games: int = 5, top_n: int | None = None, tasks: int | None = None) -> DataFrame:
    """Partners per official among all pairs with enough games.

    With ``top_n`` only the most frequent pairs count; half the summed games,
    rounded down, is the official's total.
    """
    pairs = pair_counts(games, tasks) if top_n is None else frequent_pairs(games, top_n, tasks)
    pairs = pairs.where(F.col("games_together") >= min_games)
    ends = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("official_1").alias("official"), F.col("official_2").alias("partner"), "games_together"),
                F.struct(F.col("official_2").alias("official"), F.col("official_1").alias("partner"), "games_together"),
            )
        )
    )
    # ties for the most frequent partner go to the alphabetically first
    best = F.min_by("partner", F.struct((-F.col("games_together")).alias("g"), F.col("partner").alias("p")))
    network = ends.groupBy("official").agg(
        F.count(F.lit(1)).alias("unique_partners"),
        F.floor(F.sum("games_together") / 2).alias("total_partnership_games"),
        best.alias("most_frequent_partner"),
        F.max("games_together").alias("most_frequent_partner_games"),
    )
    return network.withColumn(
        "avg_games_per_partner", F.col("total_partnership_games") / F.col("unique_partners")
    )


def name_probe(games: DataFrame, targets: Sequence[str], similar: int = 5) -> DataFrame:
    """Games of each exact name, or up to five names containing or contained in it."""
    spark = games.sparkSession
    # the caller's own list, so the broadcast is bounded
    wanted = F.broadcast(spark.createDataFrame([(t,) for t in targets], "target string"))
    worked = games.select("game_id", F.explode(F.array_distinct("officials")).alias("name")).where("name <> ''")
    names = hold(worked.groupBy("name").agg(F.count(F.lit(1)).alias("games")))
    exact = wanted.join(names, F.col("target") == F.col("name"), "left").select(
        "target", F.col("name").isNotNull().alias("found"), F.coalesce("games", F.lit(0)).alias("games")
    )
    low_t, low_n = F.lower("target"), F.lower("name")
    near = names.join(wanted, low_n.contains(low_t) | low_t.contains(low_n))
    missing = near.join(F.broadcast(exact.where(~F.col("found")).select("target")), "target", "left_semi")
    order = Window.partitionBy("target").orderBy("name")
    few = missing.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= similar)
    listed = few.groupBy("target").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("similar"))
    return exact.join(F.broadcast(listed), "target", "left")


def team_names(games: DataFrame) -> DataFrame:
    """Every name seen on either side."""
    return games.select(F.explode(F.array("home", "visitor")).alias("team")).distinct()


def team_search(games: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Team names containing each term, any case."""
    names = team_names(games)
    hits = F.filter(
        F.array(*[F.lit(t) for t in terms]), lambda t: F.lower(F.col("team")).contains(F.lower(t))
    )
    return names.select(F.explode(hits).alias("term"), "team")


def official_days(games: DataFrame) -> DataFrame:
    """One row per official, day and place; blank places and names dropped."""
    placed = games.where(F.trim("location") != "")
    return crew_members(placed).select("date", "start_time", "location", "official").distinct()
