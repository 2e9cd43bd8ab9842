"""Officials and pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.operators import crew, ranking
from rimsight.plans.registry import query
from rimsight.plans.standins import GAMES, games, line_tasks
from rimsight.session import hold, scratch_path
from rimsight.sinks import writers
from rimsight.sources import readers

TEAMS = [f"NATION_{i}" for i in range(0, 25, 2)]
TEAM_SQL = ", ".join(f"'{t}'" for t in TEAMS)
ONE = "Supplier#000000007"
OTHER = "Supplier#000000011"

MEASURES = """count(*) AS games_worked, avg(total_fouls) AS avg_fouls_per_game, min(total_fouls) AS min_fouls,
  max(total_fouls) AS max_fouls, stddev_samp(total_fouls) AS std_fouls, avg(home_fouls) AS avg_home_fouls,
  avg(visitor_fouls) AS avg_visitor_fouls, avg(home_fouls) - avg(visitor_fouls) AS home_visitor_diff,
  avg(home_technicals + visitor_technicals) AS avg_technicals"""
SCORES = """(avg_fouls_per_game - avg(avg_fouls_per_game) OVER ()) / stddev_samp(avg_fouls_per_game) OVER () AS z_score,
  (rank() OVER (ORDER BY avg_fouls_per_game) + (count(*) OVER (PARTITION BY avg_fouls_per_game) - 1) / 2.0)
    / count(*) OVER () * 100 AS percentile"""
MEASURE_DOUBLES = (
    "avg_fouls_per_game min_fouls max_fouls std_fouls avg_home_fouls avg_visitor_fouls "
    "home_visitor_diff avg_technicals z_score percentile"
)
MEMBERS = GAMES + ", members AS (SELECT *, unnest(officials) AS official FROM games)"
PAIRS = (
    MEMBERS
    + """, pairs AS (SELECT a.*, a.official AS official_1, b.official AS official_2
    FROM members a JOIN (SELECT game_id, official FROM members) b
    ON a.game_id = b.game_id AND a.official < b.official)"""
)
SIG = "official_1 || ' & ' || official_2 AS partnership_signature"


@query(
    "a1_official_profile",
    f"""WITH {MEMBERS}, p AS (SELECT official, {MEASURES} FROM members GROUP BY 1 HAVING count(*) >= 5)
    SELECT *, {SCORES} FROM p""",
    MEASURE_DOUBLES,
)
def a1(spark, d):
    return crew.official_profile(games(spark, d), 5)


@query(
    "a2_official_profile_teams",
    f"""WITH {MEMBERS}, p AS (SELECT official, {MEASURES} FROM members
      WHERE home IN ({TEAM_SQL}) AND visitor IN ({TEAM_SQL}) GROUP BY 1 HAVING count(*) >= 5)
    SELECT *, {SCORES} FROM p""",
    MEASURE_DOUBLES,
)
def a2(spark, d):
    return crew.official_profile(crew.games_between(games(spark, d), TEAMS), 5)


@query(
    "a3_partner_effect",
    f"""WITH {GAMES}, own AS (SELECT * FROM games WHERE list_contains(officials, '{ONE}')),
    p AS (SELECT total_fouls, unnest(officials) AS partner FROM own)
    SELECT partner, count(*) AS games, avg(total_fouls) AS avg_fouls,
      avg(total_fouls) - (SELECT avg(total_fouls) FROM own) AS diff_from_avg
    FROM p WHERE partner <> '{ONE}' GROUP BY 1 HAVING count(*) >= 3""",
    "avg_fouls diff_from_avg",
)
def a3(spark, d):
    return crew.partner_effect(games(spark, d), ONE, 3)


@query(
    "a4_pair_profile",
    f"""WITH {PAIRS}, p AS (SELECT 'All Seasons' AS season, official_1, official_2, {MEASURES}
      FROM pairs GROUP BY 2, 3 HAVING count(*) >= 10)
    SELECT {SIG}, *, {SCORES} FROM p""",
    MEASURE_DOUBLES,
)
def a4(spark, d):
    return crew.pair_profile(games(spark, d), 10, tasks=line_tasks(spark, d))


@query(
    "a4_pair_profile_by_season",
    f"""WITH {PAIRS}, p AS (SELECT CAST(season AS VARCHAR) AS season, official_1, official_2, {MEASURES}
      FROM pairs GROUP BY 1, 2, 3 HAVING count(*) >= 5)
    SELECT {SIG}, *, {SCORES} FROM p""",
    MEASURE_DOUBLES,
)
def a4_season(spark, d):
    return crew.pair_profile(games(spark, d), 5, by_season=True, tasks=line_tasks(spark, d))


@query(
    "a5_frequent_pairs",
    f"""WITH {PAIRS} SELECT {SIG}, official_1, official_2, count(*) AS games_together FROM pairs
    GROUP BY 2, 3 ORDER BY games_together DESC, official_1, official_2 LIMIT 20""",
)
def a5(spark, d):
    return crew.frequent_pairs(games(spark, d), 20, tasks=line_tasks(spark, d))


@query(
    "a6_pair_against_individuals",
    f"""WITH {PAIRS}, ind AS (SELECT official, avg(total_fouls) AS m FROM members GROUP BY 1),
    p AS (SELECT official_1, official_2, count(*) AS games_worked, avg(total_fouls) AS a FROM pairs
      GROUP BY 1, 2 HAVING count(*) >= 10)
    SELECT {SIG}, games_worked, a AS partnership_avg_fouls, (x.m + y.m) / 2 AS individual_avg_fouls,
      a - (x.m + y.m) / 2 AS performance_difference, official_1, official_2,
      x.m AS official_1_individual, y.m AS official_2_individual
    FROM p JOIN ind x ON official_1 = x.official JOIN ind y ON official_2 = y.official""",
    "partnership_avg_fouls individual_avg_fouls performance_difference official_1_individual official_2_individual",
)
def a6(spark, d):
    g = games(spark, d)
    return crew.pair_against_individuals(g, crew.pair_profile(g, 10, tasks=line_tasks(spark, d)))


SEASONS = (
    PAIRS
    + """, ps AS (SELECT official_1, official_2, season, count(*) AS games_worked, avg(total_fouls) AS avg_fouls_per_game,
    stddev_samp(total_fouls) AS std_fouls, avg(home_fouls) - avg(visitor_fouls) AS home_visitor_diff
    FROM pairs GROUP BY 1, 2, 3 HAVING count(*) >= 3),
  trends AS (SELECT * EXCLUDE (k) FROM (SELECT *, count(*) OVER (PARTITION BY official_1, official_2) AS k FROM ps) WHERE k > 1)"""
)


@query(
    "a7_pair_seasons",
    f"WITH {SEASONS} SELECT {SIG}, * FROM trends",
    "avg_fouls_per_game std_fouls home_visitor_diff",
)
def a7(spark, d):
    return crew.pair_seasons(games(spark, d), 3, tasks=line_tasks(spark, d))


@query(
    "a8_pair_trend",
    f"""WITH {SEASONS} SELECT {SIG}, official_1, official_2, count(*) AS seasons_active,
      CAST(sum(games_worked) AS BIGINT) AS total_games, arg_min(avg_fouls_per_game, season) AS first_season_avg,
      arg_max(avg_fouls_per_game, season) AS last_season_avg,
      string_agg(CAST(season AS VARCHAR), ', ' ORDER BY season) AS seasons_list,
      (arg_max(avg_fouls_per_game, season) - arg_min(avg_fouls_per_game, season)) / (count(*) - 1) AS trend_slope
    FROM trends GROUP BY official_1, official_2""",
    "first_season_avg last_season_avg trend_slope",
)
def a8(spark, d):
    return crew.pair_trend(crew.pair_seasons(games(spark, d), 3, tasks=line_tasks(spark, d)))


CHEMISTRY = (
    PAIRS
    + """, c AS (SELECT official_1, official_2, count(*) AS games_worked, avg(total_fouls) AS avg_fouls,
    var_samp(total_fouls) AS foul_variance, max(total_fouls) - min(total_fouls) AS foul_range,
    abs(avg(home_fouls) - avg(visitor_fouls)) AS home_visitor_balance, stddev_samp(total_fouls) AS std_fouls,
    var_samp(total_fouls) + 2 * abs(avg(home_fouls) - avg(visitor_fouls)) AS chemistry_score
    FROM pairs GROUP BY 1, 2 HAVING count(*) >= 8)"""
)


@query(
    "a9_pair_chemistry",
    f"""WITH {CHEMISTRY} SELECT {SIG}, *,
      row_number() OVER (ORDER BY round(chemistry_score, 9), official_1, official_2) AS chemistry_rank FROM c""",
    "avg_fouls foul_variance foul_range home_visitor_balance std_fouls chemistry_score",
)
def a9(spark, d):
    return crew.pair_chemistry(games(spark, d), 8, tasks=line_tasks(spark, d))


@query(
    "a10_pair_network",
    f"""WITH {PAIRS}, f AS (SELECT official_1, official_2, count(*) AS g FROM pairs GROUP BY 1, 2),
    e AS (SELECT official_1 AS official, official_2 AS partner, g FROM f WHERE g >= 5
      UNION ALL SELECT official_2, official_1, g FROM f WHERE g >= 5)
    SELECT official, count(*) AS unique_partners, CAST(floor(sum(g) / 2) AS BIGINT) AS total_partnership_games,
      arg_min(partner, row(-g, partner)) AS most_frequent_partner, max(g) AS most_frequent_partner_games,
      floor(sum(g) / 2) / count(*) AS avg_games_per_partner
    FROM e GROUP BY 1""",
    "avg_games_per_partner",
)
def a10(spark, d):
    return crew.pair_network(games(spark, d), 5, tasks=line_tasks(spark, d))


@query("a11_rows_per_season", f"WITH {GAMES} SELECT season, count(*) AS games FROM games GROUP BY 1")
def a11(spark, d):
    return games(spark, d).groupBy("season").agg(F.count(F.lit(1)).alias("games"))


@query(
    "p2_both_sides_in_list",
    f"""WITH {GAMES} SELECT game_id, home, visitor, total_fouls FROM games
    WHERE home IN ({TEAM_SQL}) AND visitor IN ({TEAM_SQL})""",
    "total_fouls",
)
def p2(spark, d):
    return crew.with_totals(crew.games_between(games(spark, d), TEAMS)).select("game_id", "home", "visitor", "total_fouls")


@query(
    "p3_games_of_official",
    f"WITH {GAMES} SELECT game_id, date, home, visitor FROM games WHERE list_contains(officials, '{ONE}')",
)
def p3(spark, d):
    return crew.games_of(games(spark, d), ONE).select("game_id", "date", "home", "visitor")


@query(
    "p4_common_games",
    f"""WITH {GAMES} SELECT game_id, date, home, visitor FROM games
    WHERE list_contains(officials, '{ONE}') AND list_contains(officials, '{OTHER}')""",
)
def p4(spark, d):
    return crew.games_of(games(spark, d), ONE, OTHER).select("game_id", "date", "home", "visitor")


@query(
    "p12_blank_filter",
    f"""WITH {MEMBERS} SELECT game_id, location, official FROM members
    WHERE trim(location) <> '' AND trim(official) <> ''""",
)
def p12(spark, d):
    return crew.crew_members(games(spark, d).where(F.trim("location") != "")).select("game_id", "location", "official")


PROBE = ["Supplier#000000007", "supplier#00000000", "Supplier#000000011 jr", "nobody"]
PROBE_SQL = ", ".join(f"('{t}')" for t in PROBE)


@query(
    "p13_name_probe",
    f"""WITH {MEMBERS}, t(target) AS (VALUES {PROBE_SQL}),
    n AS (SELECT official AS name, count(*) AS games FROM members GROUP BY 1),
    s AS (SELECT target, name, row_number() OVER (PARTITION BY target ORDER BY name) AS r FROM t JOIN n
      ON contains(lower(name), lower(target)) OR contains(lower(target), lower(name))
      WHERE target NOT IN (SELECT name FROM n)),
    l AS (SELECT target, string_agg(name, ', ' ORDER BY name) AS similar FROM s WHERE r <= 5 GROUP BY 1)
    SELECT t.target, n.name IS NOT NULL AS found, coalesce(n.games, 0) AS games, l.similar
    FROM t LEFT JOIN n ON t.target = n.name LEFT JOIN l ON t.target = l.target""",
)
def p13(spark, d):
    return crew.name_probe(games(spark, d), PROBE)


@query(
    "p14_team_search",
    f"""WITH {GAMES}, t AS (SELECT home AS team FROM games UNION SELECT visitor FROM games),
    terms(term) AS (VALUES ('nation_1'), ('_2'), ('zzz'))
    SELECT term, team FROM t JOIN terms ON contains(lower(team), lower(term))""",
)
def p14(spark, d):
    return crew.team_search(games(spark, d), ["nation_1", "_2", "zzz"])


@query("u9_team_domain", f"WITH {GAMES} SELECT home AS team FROM games UNION SELECT visitor FROM games")
def u9(spark, d):
    return crew.team_names(games(spark, d))


@query(
    "k5_official_days",
    f"""WITH {MEMBERS} SELECT DISTINCT date, start_time, location, official FROM members
    WHERE trim(location) <> '' AND trim(official) <> ''""",
)
def k5(spark, d):
    return crew.official_days(games(spark, d)).orderBy("date", "start_time", "location", "official")


@query(
    "k5_official_days_export",
    f"""WITH {MEMBERS} SELECT DISTINCT CAST(date AS VARCHAR) AS date, start_time, location, official FROM members
    WHERE trim(location) <> '' AND trim(official) <> ''""",
)
def k5_export(spark, d):
    """The sorted export as files with fixed fields, read back."""
    path = scratch_path(spark, "official-days")
    fields = ["date", "start_time", "location", "official"]
    writers.write_csv(crew.official_days(games(spark, d)).orderBy(*fields), path, fields)
    return readers.read_csv_rows(spark, path, ", ".join(f"{c} string" for c in fields), "official")


@query(
    "t6_sort_date_time",
    f"""WITH {MEMBERS}, days AS (SELECT DISTINCT date, start_time, location, official FROM members WHERE trim(location) <> '')
    SELECT * FROM days ORDER BY date, start_time, location, official""",
)
def t6(spark, d):
    return crew.official_days(games(spark, d)).orderBy("date", "start_time", "location", "official")


FREQUENCY = PAIRS + ", f AS (SELECT official_1, official_2, count(*) AS games_together FROM pairs GROUP BY 1, 2)"


@query("f1_pair_signature", f"WITH {PAIRS} SELECT DISTINCT official_2 AS a, official_1 AS b, {SIG} FROM pairs")
def f1(spark, d):
    # names given in reverse order must still sign alphabetically
    pairs = crew.dealt_pairs(games(spark, d).select("officials"), line_tasks(spark, d)).distinct()
    return pairs.select(
        F.col("official_2").alias("a"),
        F.col("official_1").alias("b"),
        crew.pair_signature(F.concat(F.lit(" "), "official_2"), F.concat("official_1", F.lit("  "))).alias(
            "partnership_signature"
        ),
    )


@query("f2_crew_combinations", f"WITH {PAIRS} SELECT game_id, official_1, official_2 FROM pairs")
def f2(spark, d):
    return crew.crew_pairs(games(spark, d).select("game_id", "officials"))


@query(
    "f44_short_pair_name",
    f"""WITH {PAIRS} SELECT DISTINCT {SIG}, replace(official_1, 'Supplier#', '') || ' & ' ||
      replace(official_2, 'Supplier#', '') AS short_name FROM pairs""",
)
def f44(spark, d):
    pairs = crew.pair_counts(games(spark, d), tasks=line_tasks(spark, d))
    signature = F.concat_ws(" & ", "official_1", "official_2")
    spaced = F.regexp_replace(signature, "#", "# ")
    return pairs.select(signature.alias("partnership_signature"), crew.short_pair_name(spaced).alias("short_name"))


@query(
    "w1_z_score",
    f"""WITH {FREQUENCY} SELECT official_1, official_2,
      (games_together - avg(games_together) OVER ()) / stddev_samp(games_together) OVER () AS z FROM f""",
    "z",
)
def w1(spark, d):
    counts = hold(crew.pair_counts(games(spark, d), tasks=line_tasks(spark, d)))
    return ranking.z_score(counts, "games_together", "z", 0.0).drop("games_together")


@query(
    "w2_percentile",
    f"""WITH {FREQUENCY} SELECT official_1, official_2, (rank() OVER (ORDER BY games_together)
      + (count(*) OVER (PARTITION BY games_together) - 1) / 2.0) / count(*) OVER () * 100 AS pct FROM f""",
    "pct",
)
def w2(spark, d):
    counts = hold(crew.pair_counts(games(spark, d), tasks=line_tasks(spark, d)))
    return ranking.percentile(counts, "games_together", "pct").drop("games_together")


@query(
    "w3_average_rank_change",
    f"""WITH {MEMBERS}, m AS (SELECT official, count(*) AS n, avg(total_fouls) AS f FROM members GROUP BY 1),
    r AS (SELECT official, rank() OVER (ORDER BY n DESC) + (count(*) OVER (PARTITION BY n) - 1) / 2.0 AS rank_games,
      rank() OVER (ORDER BY f DESC) + (count(*) OVER (PARTITION BY f) - 1) / 2.0 AS rank_fouls FROM m)
    SELECT official, rank_games, rank_fouls, abs(rank_games - rank_fouls) AS rank_change FROM r""",
    "rank_games rank_fouls rank_change",
)
def w3(spark, d):
    members = crew.crew_members(crew.with_totals(games(spark, d)))
    means = hold(members.groupBy("official").agg(F.count(F.lit(1)).alias("n"), F.avg("total_fouls").alias("f")))
    ranked = ranking.average_rank(means, "n", "rank_games", descending=True)
    ranked = ranking.average_rank(ranked, "f", "rank_fouls", descending=True)
    return ranked.select(
        "official", "rank_games", "rank_fouls", F.abs(F.col("rank_games") - F.col("rank_fouls")).alias("rank_change")
    )


@query(
    "w6_sequential_rank",
    f"""WITH {FREQUENCY} SELECT official_1, official_2, games_together,
      row_number() OVER (ORDER BY games_together, official_1, official_2) AS seq FROM f""",
)
def w6(spark, d):
    counts = crew.pair_counts(games(spark, d), tasks=line_tasks(spark, d))
    return ranking.number_rows(counts, [F.col("games_together"), F.col("official_1"), F.col("official_2")], "seq")


@query(
    "t1_sort_by_metric",
    f"""WITH {FREQUENCY} SELECT official_1, official_2, games_together FROM f
    ORDER BY games_together DESC, official_1, official_2""",
)
def t1(spark, d):
    return crew.pair_counts(games(spark, d), tasks=line_tasks(spark, d)).orderBy(F.desc("games_together"), "official_1", "official_2")


@query(
    "t2_head_and_tail",
    f"""WITH {FREQUENCY}, h AS (SELECT 'top' AS part, * FROM f ORDER BY games_together DESC, official_1, official_2 LIMIT 5),
    t AS (SELECT 'bottom' AS part, * FROM f ORDER BY games_together, official_1 DESC, official_2 DESC LIMIT 5)
    SELECT * FROM h UNION ALL SELECT * FROM t""",
)
def t2(spark, d):
    counts = hold(crew.pair_counts(games(spark, d), tasks=line_tasks(spark, d)))
    head = counts.orderBy(F.desc("games_together"), "official_1", "official_2").limit(5)
    tail = counts.orderBy("games_together", F.desc("official_1"), F.desc("official_2")).limit(5)
    return head.select(F.lit("top").alias("part"), "*").unionByName(tail.select(F.lit("bottom").alias("part"), "*"))


@query(
    "t3_largest_n",
    f"WITH {FREQUENCY} SELECT * FROM f ORDER BY games_together DESC, official_1, official_2 LIMIT 15",
)
def t3(spark, d):
    return crew.pair_counts(games(spark, d), tasks=line_tasks(spark, d)).orderBy(F.desc("games_together"), "official_1", "official_2").limit(15)


@query(
    "p6_minimum_sample",
    f"""WITH {MEMBERS}, ok AS (SELECT official FROM members GROUP BY 1 HAVING count(*) >= 400)
    SELECT game_id, official FROM members WHERE official IN (SELECT official FROM ok)""",
)
def p6(spark, d):
    members = crew.crew_members(games(spark, d)).select("game_id", "official")
    enough = members.groupBy("official").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 400)
    return members.join(enough, "official", "left_semi")
