"""Nested game documents to play, official and game rows; play pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimsight.functions.strings import clock_seconds, let, made_attempted, name_list, percent
from rimsight.operators.keyed import last_per_key

_SIDE = "struct<Name:string,Score:int,PeriodScores:array<int>,PeriodTimeouts:array<int>>"
_VALUES = "struct<Values:map<string,string>>"
_TOTALS = f"struct<Totals:{_VALUES},PlayerGroups:struct<Players:struct<Values:array<map<string,string>>>>,PeriodStats:array<{_VALUES}>>"
GAME_SCHEMA = (
    f"ncaa_id int, game_id string, Game struct<Date:string,StartTime:string,Location:string,Officials:string,"
    f"Attendance:int,HomeTeam:{_SIDE},VisitingTeam:{_SIDE}>, Stats struct<HomeTeam:{_TOTALS},VisitingTeam:{_TOTALS}>, "
    "Leaders struct<HomeTeam:map<string,string>,VisitingTeam:map<string,string>>, Plays array<struct<Type:string,Action:string,Period:int,ClockSeconds:int,Id:bigint,Team:string,"
    "Player:struct<Team:string,UniformNumber:string>>>"
)
WMT_SCHEMA = (
    "ncaa_id int, game_id string, data struct<game_date:string,competitors:array<struct<schoolId:bigint,nameTabular:string>>,"
    "actions:struct<data:array<struct<school_id:bigint,action:struct<play_action_sub_type:string,name_tabular:string,"
    "play_successful:boolean,period_number:int,play_time:string,id:bigint>>>>>"
)
# what layups need of a document
LAYUP_SCHEMA = "Game struct<Date:string,HomeTeam:struct<Name:string>,VisitingTeam:struct<Name:string>>, " + GAME_SCHEMA[GAME_SCHEMA.index("Plays ") :]
PLAY_FIELDS = ["date", "team", "opponent", "type", "action", "period", "seconds", "uniform", "play_id"]
# fixed values: categories of a side's leaders and their columns
LEADERS = {
    "Points": "points", "Rebounds": "rebounds", "Assists": "assists", "Blocks": "blocks", "Steals": "steals",
    "Personal Fouls": "fouls", "Efficiency": "efficiency", "Usage Percentage": "usage_percent",
}

# fixed values: kind of cell, total's key, output column(s)
TOTALS = [
    ("pair", "Fgam", "fgm fga"), ("percent", "ShootingPercentage", "fgpct"), ("pair", "Tpam", "3ptm 3pta"),
    ("percent", "Tppercentage", "3ptpct"), ("pair", "Ftma", "ftm fta"), ("percent", "Ftp", "ftpct"),
    ("int", "TotalRebounds", "rebounds"), ("int", "OffensiveRebounds", "rebounds_off"), ("int", "DefensiveRebounds", "rebounds_def"),
    ("int", "Leads", "leads"), ("text", "TimeWithLead", "lead_time"), ("percent", "PercentLead", "percent_lead"),
    ("int", "LargestLead", "largest_lead"), ("text", "LargestLeadScores", "largest_lead_score"),
    ("first word", "LargestLeadTime", "largest_lead_time"), ("int", "Assists", "assists"), ("int", "Turnovers", "turnovers"),
    ("int", "PointsFromBench", "bench_points"), ("int", "Blocks", "blocks"), ("int", "PointsOffFastBreak", "fast_break_points"),
    ("int", "Steals", "steals"), ("int", "PointsOffTurnovers", "points_off_turnovers"), ("int", "PointsInPaint", "points_paint"),
    ("int", "PointsOffSecondChance", "points_second_chance"), ("int", "PersonalFouls", "personal_fouls"),
    ("int", "TechnicalFouls", "technical_fouls"),
]


def _play_fields(game: Column, play: Column) -> list[Column]:
    """A play's date, team and opponent and its own values; its side is the player's, or the play's own when it has no player."""
    visiting = F.when(play["Player"].isNull(), play["Team"]).otherwise(play["Player"]["Team"]) == "VisitingTeam"
    home, away = game["HomeTeam"]["Name"], game["VisitingTeam"]["Name"]
    return [
        game["Date"].alias("date"),
        F.when(visiting, away).otherwise(home).alias("team"),
        F.when(visiting, home).otherwise(away).alias("opponent"),
        play["Type"].alias("type"),
        play["Action"].alias("action"),
        play["Period"].alias("period"),
        play["ClockSeconds"].alias("seconds"),
        play["Player"]["UniformNumber"].alias("uniform"),
        play["Id"].alias("play_id"),
    ]


def play_rows(docs: DataFrame) -> DataFrame:
    """Every play with its team, opponent and the side flip."""
    rows = docs.select("ncaa_id", "game_id", "Game", F.explode("Plays").alias("play"))
    return rows.select("ncaa_id", "game_id", *_play_fields(F.col("Game"), F.col("play")))


def turnovers(docs: DataFrame) -> DataFrame:
    return play_rows(docs).where(F.col("type") == "TURNOVER").drop("type", "action")


def layups(docs: DataFrame, teams: DataFrame) -> DataFrame:
    """Layups of the tracked team only (``teams``: ncaa_id, stats_name)."""
    rows = play_rows(docs).where(F.col("type") == "LAYUP").drop("type")
    tracked = teams.select("ncaa_id", F.col("stats_name").alias("team")).where(F.col("team").isNotNull())
    return rows.join(tracked, ["ncaa_id", "team"]).select(*rows.columns)


def _other_is_layup(play: Column) -> Column:
    return play["action"]["play_action_sub_type"].isin("layup", "drivinglayup")


def _other_fields(date: Column, sides: Column, play: Column) -> list[Column]:
    """The same of a play of the other feed, without its type: success as GOOD or MISS."""
    other = F.filter(
        sides, lambda s: s["schoolId"].isNotNull() & s["nameTabular"].isNotNull() & ~s["schoolId"].eqNullSafe(play["school_id"])
    )
    action = play["action"]
    return [
        date.alias("date"),
        action["name_tabular"].alias("team"),
        F.coalesce(F.get(other, F.lit(0))["nameTabular"], F.lit("")).alias("opponent"),
        F.when(F.coalesce(action["play_successful"], F.lit(False)), "GOOD").otherwise("MISS").alias("action"),
        action["period_number"].alias("period"),
        clock_seconds(action["play_time"]).alias("seconds"),
        F.lit(None).cast("string").alias("uniform"),
        action["id"].alias("play_id"),
    ]


def second_layout_layups(docs: DataFrame, teams: DataFrame) -> DataFrame:
    """Layups of the other feed: names matched with a fallback."""
    plays = docs.select("ncaa_id", "game_id", "data", F.explode("data.actions.data").alias("a")).where(_other_is_layup(F.col("a")))
    rows = plays.select("ncaa_id", "game_id", *_other_fields(F.col("data.game_date"), F.col("data.competitors"), F.col("a")))
    tracked = teams.select("ncaa_id", F.coalesce("stats_name", "team").alias("team"))
    return rows.join(tracked, ["ncaa_id", "team"]).select(*rows.columns)


def routed_layups(texts: DataFrame, teams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Layups of mixed files (ncaa_id, game_id, body text) by layout, and the files of neither.

    Each text is made and read once: the layouts' rows meet as arrays, not as a union of two readings.
    """
    has = lambda body, field: F.get_json_object(body, f"$.{field}").isNotNull()
    layout = lambda body: F.when(has(body, "Plays"), 1).when(has(body, "data"), 2).otherwise(0)

    def first(doc: Column) -> Column:
        layups = F.filter(doc["Plays"], lambda p: p["Type"] == "LAYUP")
        fields = lambda p: [f for f, name in zip(_play_fields(doc["Game"], p), PLAY_FIELDS) if name != "type"]
        return F.transform(layups, lambda p: F.struct(*fields(p)))

    def second(doc: Column) -> Column:
        data = doc["data"]
        return F.transform(
            F.filter(data["actions"]["data"], _other_is_layup),
            lambda p: F.struct(*_other_fields(data["game_date"], data["competitors"], p)),
        )

    def read(body: Column) -> Column:
        one = let(F.from_json(body, LAYUP_SCHEMA), first)
        two = let(F.from_json(body, WMT_SCHEMA.split(", ", 2)[2]), second)
        return let(layout(body), lambda k: F.struct(k.alias("layout"), F.when(k == 1, one).when(k == 2, two).alias("plays")))

    # behind a generator, so that a filter below does not make and read the text again
    found = texts.select("ncaa_id", "game_id", F.inline_outer(F.array(let(F.col("body"), read))))
    rows = found.select("ncaa_id", "game_id", "layout", F.inline("plays"))
    names = F.array(
        F.struct(F.lit(1).alias("layout"), F.col("stats_name").alias("team")),
        F.struct(F.lit(2).alias("layout"), F.coalesce("stats_name", "team").alias("team")),
    )
    tracked = teams.select("ncaa_id", F.inline(names)).where(F.col("team").isNotNull())
    layups = rows.join(tracked, ["ncaa_id", "layout", "team"]).select(*[c for c in rows.columns if c != "layout"])
    kinds = texts.select("ncaa_id", "game_id", F.inline_outer(F.array(F.struct(let(F.col("body"), layout).alias("layout")))))
    return layups, kinds.where(F.col("layout") == 0).select("ncaa_id", "game_id")


def official_rows(docs: DataFrame) -> DataFrame:
    """One row per game that names its officials: fouls and technicals of both sides."""
    value = lambda side, key: F.col(f"Stats.{side}.Totals.Values")[key].try_cast("int")
    return docs.where(F.coalesce(F.col("Game.Officials"), F.lit("")) != "").select(
        "ncaa_id",
        "game_id",
        F.col("Game.Date").alias("date"),
        F.col("Game.HomeTeam.Name").alias("home"),
        value("HomeTeam", "PersonalFouls").alias("home_fouls"),
        value("HomeTeam", "TechnicalFouls").alias("home_technicals"),
        F.col("Game.VisitingTeam.Name").alias("visitor"),
        value("VisitingTeam", "PersonalFouls").alias("visitor_fouls"),
        value("VisitingTeam", "TechnicalFouls").alias("visitor_technicals"),
        F.col("Game.Officials").alias("officials"),
    )


def _totals(side: str, prefix: str) -> Column:
    """All totals of a side from its values, which are worked out once and not for each total."""
    return let(F.col(f"Stats.{side}.Totals.Values"), lambda values: F.struct(*_read_totals(values, prefix)))


def _read_totals(values: Column, prefix: str) -> list[Column]:
    out = []
    for kind, key, names in TOTALS:
        cell, columns = values[key], [f"{prefix}_{n}" for n in names.split()]
        if kind == "pair":
            out += [c.alias(n) for c, n in zip(made_attempted(cell), columns)]
        else:
            made = {"percent": percent(cell), "int": cell.try_cast("int"), "text": cell, "first word": F.split(cell, " ")[0]}[kind]
            out.append(made.alias(columns[0]))
    return out


def game_facts(docs: DataFrame) -> DataFrame:
    """One typed row per game with every total of both sides."""
    facts = docs.select(
        "game_id",
        F.col("Game.HomeTeam.Name").alias("home_team"),
        F.col("Game.VisitingTeam.Name").alias("visiting_team"),
        F.col("Game.Location").alias("location"),
        F.col("Game.Date").alias("date"),
        F.col("Game.StartTime").alias("time"),
        F.col("Game.Attendance").alias("attendance"),
        F.col("Game.HomeTeam.Score").alias("home_team_score"),
        F.col("Game.VisitingTeam.Score").alias("visiting_team_score"),
        F.inline(F.array(F.struct(_totals("HomeTeam", "home_team").alias("_home"), _totals("VisitingTeam", "visiting_team").alias("_visiting")))),
    )
    return facts.select(*facts.columns[:-2], "_home.*", "_visiting.*")


def game_officials(docs: DataFrame) -> DataFrame:
    return docs.select("game_id", F.explode(name_list("Game.Officials")).alias("official")).where("official <> ''").distinct()


def game_record(docs: DataFrame) -> DataFrame:
    """A document's own properties: date, place, crew, scores by period, leaders, plays."""
    side = lambda s, p: [
        F.col(f"Game.{s}.Name").alias(p), F.col(f"Game.{s}.Score").alias(f"{p}_score"),
        F.array_join(F.transform(f"Game.{s}.PeriodScores", lambda x: x.cast("string")), "-").alias(f"{p}_periods"),
        F.aggregate(f"Game.{s}.PeriodTimeouts", F.lit(0), lambda a, x: a + x).alias(f"{p}_timeouts"),
    ]
    return docs.select(
        "ncaa_id", "game_id", F.col("Game.Date").alias("date"), F.col("Game.StartTime").alias("start_time"),
        F.col("Game.Location").alias("location"), F.array_join(name_list("Game.Officials"), "|").alias("officials"),
        F.col("Game.Attendance").alias("attendance"), *side("HomeTeam", "home"), *side("VisitingTeam", "visitor"),
        *[
            F.try_element_at(f"Leaders.{s}", F.lit(k)).alias(f"{p}_leader_{c}")
            for s, p in (("HomeTeam", "home"), ("VisitingTeam", "visitor"))
            for k, c in LEADERS.items()
        ],
        F.size("Plays").alias("plays"),
    )


def player_rows(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per player of each side with the named values of the player's box score (null where absent)."""
    return _value_rows(docs, lambda s: F.col(f"Stats.{s}.PlayerGroups.Players.Values"), keys)


def period_rows(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per period of each side with the named values of the side's period statistics."""
    return _value_rows(docs, lambda s: F.transform(f"Stats.{s}.PeriodStats", lambda x: x["Values"]), keys)


def _value_rows(docs: DataFrame, values, keys: Sequence[str]) -> DataFrame:
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"Game.{s}.Name").alias("team"), values(s).alias("v")) for s in ("HomeTeam", "VisitingTeam")])
    each = docs.select("ncaa_id", "game_id", F.inline(sides)).select("*", F.posexplode("v").alias("number", "row")).drop("v")
    return each.select("ncaa_id", "game_id", "side", "team", (F.col("number") + 1).alias("number"), *[F.try_element_at("row", F.lit(k)).alias(k) for k in keys])


def people_of(docs: DataFrame, people: str, key: str, order: str) -> DataFrame:
    """People inside team documents (``t.tid``, ``t.<people>``), one row per person, last document wins."""
    rows = docs.select(F.col("t.tid").alias("team_id"), order, F.explode(f"t.{people}").alias("p")).select("team_id", order, "p.*")
    return last_per_key(rows, [key], [F.col(order), F.col("team_id")]).drop(order)


def two_sided_rows(docs: DataFrame) -> DataFrame:
    """Player rows of both sides with the other side's name and score.

    ``sides`` is an array of two structs: name, score, players.
    """
    own = docs.select("*", F.posexplode("sides").alias("_i", "own"))
    other = F.element_at("sides", 2 - F.col("_i"))
    return own.withColumn("other", other).select(
        "game_id",
        F.col("own.name").alias("country"),
        F.col("other.name").alias("vs"),
        F.col("own.score").alias("team_score"),
        F.col("other.score").alias("vs_score"),
        F.explode("own.players").alias("player"),
    )


def padded(cells: Column, defaults: Sequence[str], width: int) -> Column:
    """Rows shorter than the header lose their last cell and get the default cells."""
    kept = F.slice(cells, 1, F.greatest(F.size(cells) - 1, F.lit(0)))
    return F.when(F.size(cells) < width, F.concat(kept, F.array(*[F.lit(x) for x in defaults]))).otherwise(cells)


def outcome_pivot(plays: DataFrame, outcomes: Sequence[str] = ("GOOD", "MISS")) -> DataFrame:
    """Counts per team and outcome as columns, total and share missed."""
    table = plays.groupBy("team").pivot("action", list(outcomes)).agg(F.count(F.lit(1)))
    good, miss = F.col(outcomes[0]), F.col(outcomes[1])
    return table.withColumn("total", good + miss).withColumn("pct_miss", F.try_divide(miss, F.col("total")))


def season_counts(files: DataFrame, teams: DataFrame, seasons: Sequence[str]) -> DataFrame:
    """Files per team and season, every team present, zeros filled."""
    table = files.groupBy("ncaa_id").pivot("season", list(seasons)).agg(F.count(F.lit(1)))
    return teams.join(table, "ncaa_id", "left").fillna(0, subset=list(seasons))


def without_files(counts: DataFrame, season: str) -> DataFrame:
    """Teams with no file in a season; an unknown season is an error."""
    if season not in counts.columns:
        raise ValueError(f"season {season} not found")
    return counts.where(F.col(f"`{season}`") == 0).select("ncaa_id", "team")


def shooting_summary(shots: DataFrame) -> DataFrame:
    """Made, attempted and rate of all, three-point and two-point shots per team."""
    made, three = F.col("outcome") == "made", F.col("three_pointer")
    table = shots.groupBy("team").agg(
        F.count_if(made).alias("made"), F.count(F.lit(1)).alias("total"),
        F.count_if(made & three).alias("made_3"), F.count_if(three).alias("total_3"),
    )
    table = table.withColumn("made_2", F.col("made") - F.col("made_3")).withColumn("total_2", F.col("total") - F.col("total_3"))
    rates = {"rate": ("made", "total"), "rate_3": ("made_3", "total_3"), "rate_2": ("made_2", "total_2")}
    return table.withColumns({n: F.try_divide(a, b) for n, (a, b) in rates.items()})


def court_position(shots: DataFrame, second: Column) -> DataFrame:
    """Plot coordinates: the second team mirrored to the other half."""
    x = F.col("coord_x") * 0.8
    return shots.withColumn("court_x", F.when(second, 50 - x).otherwise(x)).withColumn("court_y", F.col("coord_y") * 1.0)


def free_throw_share(players: DataFrame, attempts: float = 100, rate: float = 0.2) -> DataFrame:
    """Per season: share of players with enough attempts whose free throws per attempt reach the rate."""
    kept = players.where(F.col("fga") >= attempts)
    hit = (F.try_divide("ftm", "fga") >= rate).cast("double")
    return kept.groupBy("season").agg(F.count(F.lit(1)).alias("players"), F.avg(hit).alias("share"))


def roster_gaps(teams: DataFrame, rows: DataFrame) -> DataFrame:
    """Teams whose season check failed, and teams that passed it but have no rows."""
    counts = rows.groupBy("team_id").agg(F.count(F.lit(1)).alias("n"))
    joined = teams.join(counts, "team_id", "left")
    issue = F.when(~F.col("season_ok"), "failed check").when(F.coalesce("n", F.lit(0)) == 0, "no rows")
    return joined.withColumn("issue", issue).where(F.col("issue").isNotNull()).select("team_id", "team_name", "issue")


def winner_and_margin(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("team1_score") > F.col("team2_score"), F.col("team1")).otherwise(F.col("team2"))
    won = games.withColumn("winner", winner)
    return won.where(F.col("team1") == F.col("winner")).withColumn("margin", F.col("team1_score") - F.col("team2_score"))
