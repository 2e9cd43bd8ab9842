"""Play-by-play documents and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.operators import plays
from rimsight.plans.registry import query
from rimsight.plans.standins import DOCS, GAMES, TOTAL_TEXTS, event_plays, game_docs, games, table


@query("g1_all_plays", f"WITH {DOCS} SELECT * FROM plays")
def g1(spark, d):
    return plays.play_rows(game_docs(spark, d))


@query("g2_turnovers", f"WITH {DOCS} SELECT * EXCLUDE (type, action) FROM plays WHERE type = 'TURNOVER'")
def g2(spark, d):
    return plays.turnovers(game_docs(spark, d))


def tracked(spark, d):
    nation = table(spark, d, "nation")
    return nation.select(
        F.col("n_nationkey").alias("ncaa_id"),
        F.concat(F.lit("T"), "n_name").alias("team"),
        F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("stats_name"),
    )


@query(
    "g3_tracked_layups",
    f"""WITH {DOCS} SELECT p.* EXCLUDE (type) FROM plays p JOIN nation ON n_nationkey = p.ncaa_id AND n_regionkey <> 2 AND n_name = p.team WHERE type = 'LAYUP'""",
)
def g3(spark, d):
    return plays.layups(game_docs(spark, d), tracked(spark, d))


def second_layout(spark, d):
    """The same games in the other feed's shape, layups only in its own vocabulary."""
    docs = in_regions(spark, d, game_docs(spark, d))
    return docs.select("ncaa_id", "game_id", second_data().alias("data"))


def in_regions(spark, d, docs, how="inner"):
    region = table(spark, d, "nation").select(F.col("n_nationkey").alias("ncaa_id"), F.col("n_regionkey").alias("_region"))
    return docs.join(region, "ncaa_id", how)


def second_data():
    """A document's content in the other feed's shape."""
    home, away = F.col("Game.HomeTeam.Name"), F.col("Game.VisitingTeam.Name")
    sides = F.array(
        F.struct(F.lit(1).cast("long").alias("schoolId"), home.alias("nameTabular")),
        F.struct(F.lit(2).cast("long").alias("schoolId"), away.alias("nameTabular")),
    )
    asia = F.col("_region") == 2

    def action(p):
        at_home = p["Team"] == "HomeTeam"
        kind = F.when((p["Type"] == "LAYUP") & (p["Period"] > 2), "drivinglayup").when(p["Type"] == "LAYUP", "layup").otherwise("jumper")
        name = F.when(at_home, F.when(asia, F.concat(F.lit("T"), home)).otherwise(home)).otherwise(away)
        clock = F.format_string("%02d:%02d:00", F.floor(p["ClockSeconds"] / 60).cast("int"), p["ClockSeconds"] % 60)
        return F.struct(
            F.when(at_home, 1).otherwise(2).cast("long").alias("school_id"),
            F.struct(
                kind.alias("play_action_sub_type"), name.alias("name_tabular"), (p["Action"] == "GOOD").alias("play_successful"),
                p["Period"].alias("period_number"), clock.alias("play_time"), p["Id"].alias("id"),
            ).alias("action"),
        )

    return F.struct(
        F.col("Game.Date").alias("game_date"), sides.alias("competitors"), F.struct(F.transform("Plays", action).alias("data")).alias("actions")
    )


WMT = """wmt AS (SELECT p.ncaa_id, p.game_id, date, CASE WHEN n_regionkey = 2 THEN 'T' || p.team ELSE p.team END AS team, opponent, action, period, seconds,
    CAST(NULL AS VARCHAR) AS uniform, play_id FROM plays p JOIN nation ON n_nationkey = p.ncaa_id AND n_name = p.team
    WHERE type = 'LAYUP' AND (n_regionkey <> 2 OR period % 2 = 1))"""


@query("g4_second_layout_layups", f"WITH {DOCS}, {WMT} SELECT * FROM wmt")
def g4(spark, d):
    return plays.second_layout_layups(second_layout(spark, d), tracked(spark, d))


@query("g5_official_rows", f"""WITH {DOCS} SELECT CAST(regexp_extract(home, '[0-9]+') AS BIGINT) AS ncaa_id, CAST(game_id AS VARCHAR) AS game_id, date, home,
      home_q AS home_fouls, home_r AS home_technicals, visitor, away_q AS visitor_fouls, away_r AS visitor_technicals, array_to_string(officials, ',  ') AS officials
    FROM doc WHERE location <> ''""")
def g5(spark, d):
    return plays.official_rows(game_docs(spark, d))


MIXED = """mixed AS (SELECT * FROM (SELECT p.* EXCLUDE (type) FROM plays p JOIN nation ON n_nationkey = p.ncaa_id AND n_regionkey <> 2 AND n_name = p.team
      WHERE type = 'LAYUP') WHERE date < '1998-01-01'
    UNION ALL SELECT * FROM wmt WHERE date >= '1998-01-01' AND date < '2001-01-01')"""


def mixed_bodies(spark, d):
    """One body per game, in the first layout, the second or neither by the game's date: the games are made once for all three."""
    docs, date = in_regions(spark, d, game_docs(spark, d), "left"), F.col("Game.Date")
    first, second = F.to_json(F.struct("Game", "Stats", "Leaders", "Plays")), F.to_json(F.struct(second_data().alias("data")))
    body = F.when(date < "1998-01-01", first).when(date < "2001-01-01", second).otherwise("null")
    return docs.select("ncaa_id", "game_id", body.alias("body"))


@query("g6_layout_routing", f"WITH {DOCS}, {WMT}, {MIXED} SELECT * FROM mixed")
def g6(spark, d):
    return plays.routed_layups(mixed_bodies(spark, d), tracked(spark, d))[0]


@query("g6_quarantined_files", f"WITH {DOCS} SELECT CAST(regexp_extract(home, '[0-9]+') AS BIGINT) AS ncaa_id, CAST(game_id AS VARCHAR) AS game_id FROM games WHERE date >= '2001-01-01'")
def g6_bad(spark, d):
    return plays.routed_layups(mixed_bodies(spark, d), tracked(spark, d))[1]


def _fact_sql():
    out, doubles = [], []
    for prefix, side in (("home_team", "home"), ("visiting_team", "away")):
        for kind, key, names in plays.TOTALS:
            pieces = [f"{side}_{p[1]}" + (" * 2" if p == "{q2}" else "") if p.startswith("{") else f"'{p}'" for p in TOTAL_TEXTS[key]]
            text = " || ".join(f"({p})" for p in pieces)
            columns = [f'"{prefix}_{n}"' for n in names.split()]
            if kind == "pair":
                out += [f"CAST(split_part({text}, '-', {i + 1}) AS BIGINT) AS {c}" for i, c in enumerate(columns)]
            elif kind == "percent":
                out.append(f"CAST(replace({text}, '%', '') AS DOUBLE) AS {columns[0]}")
                doubles.append(columns[0])
            elif kind == "int":
                out.append(f"CAST({text} AS BIGINT) AS {columns[0]}" if "||" not in text else f"CAST(({text}) AS BIGINT) AS {columns[0]}")
            else:
                out.append((f"split_part({text}, ' ', 1)" if kind == "first word" else f"{text}") + f" AS {columns[0]}")
    return ", ".join(out), " ".join(doubles)


FACT_SQL, FACT_DOUBLES = _fact_sql()


@query(
    "g7_game_facts",
    f"""WITH {DOCS} SELECT CAST(game_id AS VARCHAR) AS game_id, home AS home_team, visitor AS visiting_team, location, date, start_time AS time, home_q * 100 AS attendance,
      home_q AS home_team_score, away_q AS visiting_team_score, {FACT_SQL} FROM doc""",
    FACT_DOUBLES,
)
def g7(spark, d):
    return plays.game_facts(game_docs(spark, d))


@query(
    "g7_game_officials",
    f"WITH {GAMES} SELECT CAST(game_id AS VARCHAR) AS game_id, unnest(officials) AS official FROM games WHERE location <> ''",
)
def g7_officials(spark, d):
    return plays.game_officials(game_docs(spark, d))


def team_docs(spark, d):
    person = F.struct(F.col("l_suppkey").alias("pid"), F.col("l_linenumber").alias("num"), F.col("l_returnflag").alias("pos"))
    docs = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_distinct(F.array_sort(F.collect_list(person))).alias("pl"))
    # one entry per person in a document: its first
    return docs.select(
        F.col("l_orderkey").alias("batch"), F.struct(F.col("l_orderkey").alias("tid"), F.col("pl")).alias("t")
    )


@query(
    "g8_people_upsert",
    """SELECT l_suppkey AS pid, max(l_orderkey) AS team_id FROM lineitem GROUP BY 1""",
)
def g8(spark, d):
    return plays.people_of(team_docs(spark, d), "pl", "pid", "batch").select("pid", "team_id")


@query(
    "g9_two_sided_rows",
    f"""WITH {DOCS} SELECT CAST(game_id AS VARCHAR) AS game_id, team AS country, opponent AS vs,
      CASE WHEN period % 2 = 1 THEN home_q ELSE away_q END AS team_score, CASE WHEN period % 2 = 1 THEN away_q ELSE home_q END AS vs_score, play_id AS player
    FROM plays p JOIN (SELECT game_id AS gid, home_q, away_q FROM doc) ON CAST(gid AS VARCHAR) = p.game_id""",
)
def g9(spark, d):
    def side(name):
        ids = F.transform(F.filter("Plays", lambda p: p["Team"] == name), lambda p: p["Id"])
        return F.struct(F.col(f"Game.{name}.Name").alias("name"), F.col(f"Game.{name}.Score").alias("score"), ids.alias("players"))

    docs = game_docs(spark, d).select("game_id", F.array(side("HomeTeam"), side("VisitingTeam")).alias("sides"))
    return plays.two_sided_rows(docs)


@query("j19_opponent_of_play", f"WITH {DOCS} SELECT game_id, play_id, team, opponent FROM plays")
def j19(spark, d):
    return plays.play_rows(game_docs(spark, d)).select("game_id", "play_id", "team", "opponent")


EVENT_PLAYS = """ep AS (SELECT event_id AS play_id, user_id % 25 AS ncaa_id, 'Team ' || user_id % 25 AS team, event_type AS type,
    CASE WHEN value >= 20 THEN 'GOOD' ELSE 'MISS' END AS action, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


@query(
    "a15_outcome_pivot",
    f"""WITH {EVENT_PLAYS} SELECT team, count(*) FILTER (action = 'GOOD') AS "GOOD", count(*) FILTER (action = 'MISS') AS "MISS", count(*) AS total,
      count(*) FILTER (action = 'MISS') / count(*) AS pct_miss FROM ep GROUP BY 1""",
    "pct_miss",
)
def a15(spark, d):
    return plays.outcome_pivot(event_plays(spark, d))


@query(
    "a15_outcome_pivot_by_type",
    f"""WITH {EVENT_PLAYS} SELECT type AS team, count(*) FILTER (action = 'GOOD') AS "GOOD", count(*) FILTER (action = 'MISS') AS "MISS", count(*) AS total,
      count(*) FILTER (action = 'MISS') / count(*) AS pct_miss FROM ep GROUP BY 1""",
    "pct_miss",
)
def a15_type(spark, d):
    rows = event_plays(spark, d).select(F.col("type").alias("team"), "action")
    return plays.outcome_pivot(rows)


SEASONS = [str(y) for y in range(1995, 2003)]
COUNTS = (
    GAMES
    + """, teams AS (SELECT n_nationkey::BIGINT AS ncaa_id, n_name AS team FROM nation UNION ALL SELECT 100 + r_regionkey, r_name FROM region),
cnt AS (SELECT ncaa_id, team, """
    + ", ".join(f"count(*) FILTER (season = {y}) AS \"{y}\"" for y in SEASONS)
    + " FROM teams LEFT JOIN (SELECT home, season FROM games) ON home = team GROUP BY 1, 2)"
)


def season_counts(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    teams = nation.select(F.col("n_nationkey").alias("ncaa_id"), F.col("n_name").alias("team")).unionByName(
        region.select((F.col("r_regionkey") + 100).alias("ncaa_id"), F.col("r_name").alias("team"))
    )
    files = games(spark, d).select(F.regexp_extract("home", r"(\d+)", 1).cast("int").alias("ncaa_id"), F.col("season").cast("string").alias("season"))
    return plays.season_counts(files, teams, SEASONS)


@query("a16_season_file_counts", f"WITH {COUNTS} SELECT * FROM cnt")
def a16(spark, d):
    return season_counts(spark, d)


@query("a17_teams_without_files", f'WITH {COUNTS} SELECT ncaa_id, team FROM cnt WHERE "2001" = 0')
def a17(spark, d):
    return plays.without_files(season_counts(spark, d), "2001")


SHOTS = """shots AS (SELECT n_name AS team, CASE WHEN l_linestatus = 'O' THEN 'made' ELSE 'missed' END AS outcome, l_discount > 0.05 AS three_pointer,
    l_quantity AS coord_x, CAST(l_linenumber AS DOUBLE) AS coord_y, l_orderkey, l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey)"""


def shots(spark, d):
    joined = (
        table(spark, d, "lineitem")
        .join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(
        F.col("n_name").alias("team"),
        F.when(F.col("l_linestatus") == "O", "made").otherwise("missed").alias("outcome"),
        (F.col("l_discount") > 0.05).alias("three_pointer"),
        F.col("l_quantity").alias("coord_x"),
        F.col("l_linenumber").cast("double").alias("coord_y"),
        "l_orderkey",
        "l_partkey",
    )


@query(
    "a18_shooting_summary",
    f"""WITH {SHOTS}, s AS (SELECT team, count(*) FILTER (outcome = 'made') AS made, count(*) AS total,
      count(*) FILTER (outcome = 'made' AND three_pointer) AS made_3, count(*) FILTER (three_pointer) AS total_3 FROM shots GROUP BY 1)
    SELECT *, made - made_3 AS made_2, total - total_3 AS total_2, made / total AS rate, made_3 / total_3 AS rate_3, (made - made_3) / (total - total_3) AS rate_2 FROM s""",
    "rate rate_3 rate_2",
)
def a18(spark, d):
    return plays.shooting_summary(shots(spark, d))


@query(
    "f47_court_position",
    f"""WITH {SHOTS} SELECT l_orderkey, l_partkey, CASE WHEN outcome = 'made' THEN 50 - coord_x * 0.8 ELSE coord_x * 0.8 END AS court_x, coord_y AS court_y FROM shots""",
    "court_x court_y",
)
def f47(spark, d):
    return plays.court_position(shots(spark, d), F.col("outcome") == "made").select("l_orderkey", "l_partkey", "court_x", "court_y")


DEFAULTS = ["0:0", "0"] + ["0/0"] * 4 + ["0"] * 10


@query(
    "f48_padded_rows",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN l_linenumber || '|P' || l_suppkey || '|0:0|0|0/0|0/0|0/0|0/0|0|0|0|0|0|0|0|0|0|0'
      ELSE l_linenumber || '|P' || l_suppkey || '|10:00|5|1/2|1/2|1/2|1/2|1|1|1|1|1|1|1|1|1|1' END AS cells FROM lineitem""",
)
def f48(spark, d):
    head = [F.col("l_linenumber").cast("string"), F.concat(F.lit("P"), F.col("l_suppkey").cast("string"))]
    played = F.array(*head, *[F.lit(x) for x in ["10:00", "5"] + ["1/2"] * 4 + ["1"] * 10])
    cells = F.when(F.col("l_returnflag") == "N", F.array(*head, F.lit("DNP"))).otherwise(played)
    out = F.array_join(plays.padded(cells, DEFAULTS, len(DEFAULTS) + 2), "|").alias("cells")
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", out)


@query(
    "a38_free_throw_share",
    """WITH p AS (SELECT l_suppkey, CAST(year(l_shipdate) AS BIGINT) AS season, sum(l_quantity) AS fga, sum(l_linenumber) AS ftm FROM lineitem GROUP BY 1, 2)
    SELECT season, count(*) AS players, avg(CASE WHEN ftm / fga >= 0.16 THEN 1.0::DOUBLE ELSE 0 END) AS share FROM p WHERE fga >= 100 GROUP BY 1""",
    "share",
)
def a38(spark, d):
    players = table(spark, d, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("season")).agg(
        F.sum("l_quantity").alias("fga"), F.sum("l_linenumber").alias("ftm")
    )
    return plays.free_throw_share(players, 100, 0.16)


@query(
    "a40_roster_gaps",
    """WITH r AS (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
    SELECT c_custkey AS team_id, c_name AS team_name, CASE WHEN NOT c_acctbal > 0 THEN 'failed check' ELSE 'no rows' END AS issue FROM customer
    WHERE NOT c_acctbal > 0 OR c_custkey NOT IN (SELECT o_custkey FROM r)""",
)
def a40(spark, d):
    teams = table(spark, d, "customer").select(
        F.col("c_custkey").alias("team_id"), F.col("c_name").alias("team_name"), (F.col("c_acctbal") > 0).alias("season_ok")
    )
    rows = table(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(F.col("o_custkey").alias("team_id"))
    return plays.roster_gaps(teams, rows)


@query(
    "f26_winner_and_margin",
    f"""WITH {GAMES} SELECT DISTINCT date, home AS team1, home_fouls AS team1_score, visitor AS team2, visitor_fouls AS team2_score, home AS winner,
      home_fouls - visitor_fouls AS margin FROM games WHERE home_fouls > visitor_fouls OR home = visitor""",
    "team1_score team2_score margin",
)
def f26(spark, d):
    g = games(spark, d).select(
        "date", F.col("home").alias("team1"), F.col("home_fouls").alias("team1_score"), F.col("visitor").alias("team2"), F.col("visitor_fouls").alias("team2_score")
    )
    return plays.winner_and_margin(g.distinct())
