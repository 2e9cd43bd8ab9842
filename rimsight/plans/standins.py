"""Projections of the given tables onto the shapes the operators read.

``TABLES`` holds the same projections as SQL, for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimsight.session import tasks_for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with the supplier they name."""
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return table(spark, d, "lineitem").join(sup, F.col("l_suppkey") == F.col("s_suppkey"))


def _odd(value):
    return F.when(F.col("l_linenumber") % 2 == 1, value).otherwise(0)


def _even(value):
    return F.when(F.col("l_linenumber") % 2 == 0, value).otherwise(0)


def line_tasks(spark: SparkSession, d: str) -> int:
    """Tasks for the line items, or for rows made of them (a crew's pairs are about twice its lines)."""
    return tasks_for(spark, table(spark, d, "lineitem").count())


def games(spark: SparkSession, d: str) -> DataFrame:
    """One row per order: crew = its suppliers, fouls = quantities by side."""
    tasks = line_tasks(spark, d)
    qty, red = F.col("l_quantity"), (F.col("l_returnflag") == "R").cast("long")
    # an order's few lines are not put together before the shuffle, and both sides of the join are dealt out alike
    dealt = lines(spark, d).repartition(tasks, "l_orderkey")
    crew = dealt.groupBy(F.col("l_orderkey").alias("game_id")).agg(
        F.array_sort(F.collect_set("s_name")).alias("officials"),
        F.sum(_odd(qty)).cast("double").alias("home_fouls"),
        F.sum(_even(qty)).cast("double").alias("visitor_fouls"),
        F.sum(_odd(red)).alias("home_technicals"),
        F.sum(_even(red)).alias("visitor_technicals"),
        F.min_by("s_nationkey", F.struct("l_linenumber", "l_suppkey")).alias("visitor_key"),
    )
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    home = (
        table(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("n_name").alias("home"), "r_name", "c_mktsegment")
    )
    visitor = nation.select(F.col("n_nationkey").alias("visitor_key"), F.col("n_name").alias("visitor"))
    # customers meet the narrow orders first, so that the wide crew rows are not dealt out again by customer
    ordered = table(spark, d, "orders").join(home, F.col("o_custkey") == F.col("c_custkey")).repartition(tasks, "o_orderkey")
    return (
        crew.join(ordered, F.col("game_id") == F.col("o_orderkey"))
        .join(visitor, "visitor_key")
        .select(
            "game_id",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.year("o_orderdate").alias("season"),
            "home",
            "visitor",
            "officials",
            "home_fouls",
            "visitor_fouls",
            "home_technicals",
            "visitor_technicals",
            F.format_string("%02d:00", F.col("game_id") % 10 + 12).alias("start_time"),
            F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("r_name")).alias("location"),
        )
    )


GAMES = """
ln AS (SELECT l.*, s_suppkey, s_name, s_nationkey FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey),
crew AS (
  SELECT l_orderkey AS game_id, list_sort(list(DISTINCT s_name)) AS officials,
    sum(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity ELSE 0 END) AS home_fouls,
    sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END) AS visitor_fouls,
    CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber % 2 = 1) AS BIGINT) AS home_technicals,
    CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber % 2 = 0) AS BIGINT) AS visitor_technicals,
    arg_min(s_nationkey, row(l_linenumber, l_suppkey)) AS visitor_key
  FROM ln GROUP BY l_orderkey),
games AS (
  SELECT game_id, strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(year(o_orderdate) AS BIGINT) AS season,
    h.n_name AS home, v.n_name AS visitor, officials, home_fouls, visitor_fouls,
    home_technicals, visitor_technicals, home_fouls + visitor_fouls AS total_fouls,
    CAST(game_id % 10 + 12 AS VARCHAR) || ':00' AS start_time,
    CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE r_name END AS location
  FROM crew JOIN orders ON game_id = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation h ON c_nationkey = h.n_nationkey JOIN region ON h.n_regionkey = r_regionkey
  JOIN nation v ON visitor_key = v.n_nationkey)
"""


def team_box(spark: SparkSession, d: str) -> DataFrame:
    """Two rows per order: odd lines are the home team's, even lines the visitors', named after the first one's nation."""
    qty = F.col("l_quantity")
    red = F.col("l_returnflag") == "R"
    # odd lines are the home side's, even lines the visitors'; every line counts
    side = (F.col("l_linenumber") % 2).alias("home")
    # an order's lines are dealt out once: its sides, its teams and an opponent's side are then where they are
    dealt = lines(spark, d).repartition(line_tasks(spark, d), "l_orderkey")
    stats = dealt.groupBy(F.col("l_orderkey").alias("game_id"), side).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.sum(qty).alias("qty"),
        F.sum(F.when(red, qty).otherwise(0)).alias("red_qty"),
        F.round(F.sum("l_tax"), 2).alias("tax"),
        F.round(F.sum("l_discount"), 2).alias("disc"),
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("l_linestatus") == "O").cast("long")).alias("n_open"),
        F.sum((F.col("l_returnflag") == "A").cast("long")).alias("n_a"),
        F.min(F.struct("l_linenumber", "s_nationkey"))["s_nationkey"].alias("nation"),
    )
    # the home team is the first odd line's nation, the visitors the first even line's or, if that is the same, the next
    own = F.struct("price", "nation")
    ends = stats.groupBy("game_id").agg(F.max(F.when(F.col("home") == 1, own)).alias("h"), F.max(F.when(F.col("home") == 0, own)).alias("v"))
    h, v = F.col("h.nation"), F.col("v.nation")
    away = F.when(h == v, (v + 1) % 25).otherwise(v)
    first_wins = F.col("v.price").isNull() | (F.col("h.price") > F.col("v.price")) | ((F.col("h.price") == F.col("v.price")) & (h < away))
    named = ends.select("game_id", h.alias("home_id"), away.alias("away_id"), F.when(first_wins, h).otherwise(away).alias("winner"))
    one = stats.join(named, "game_id").withColumn("team_id", F.when(F.col("home") == 1, F.col("home_id")).otherwise(F.col("away_id")))
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_short_display_name"))
    return (
        one.join(nation, "team_id")
        .select(
            "game_id",
            "team_id",
            "team_short_display_name",
            (F.col("team_id") == F.col("winner")).alias("team_winner"),
            (F.col("price") / 1000).alias("team_score"),
            (2 * qty_("qty")).alias("field_goals_attempted"),
            (qty_("qty") * (1 - F.col("disc") / F.col("n"))).alias("field_goals_made"),
            qty_("red_qty").alias("three_point_field_goals_attempted"),
            (qty_("red_qty") / 2).alias("three_point_field_goals_made"),
            (100 * F.col("tax")).alias("free_throws_attempted"),
            (80 * F.col("tax") * (1 - F.col("disc") / F.col("n"))).alias("free_throws_made"),
            (F.col("n_open") + 1).cast("double").alias("offensive_rebounds"),
            (F.col("n") + 2).cast("double").alias("defensive_rebounds"),
            (F.col("n") + F.col("n_a")).cast("double").alias("turnovers"),
            F.col("n").cast("double").alias("assists"),
            F.when(F.col("n_a") == 3, "n/a")
            .otherwise(share_text(F.col("n_open"), 2_000_000))
            .alias("points_in_paint"),
            F.when(F.col("n_a") == 4, "--")
            .otherwise(share_text(F.col("n_a"), 3_000_000))
            .alias("fast_break_points"),
        )
    )


def share_text(count, divisor: int):
    """A whole number of points as text, by whole-number arithmetic on cents."""
    cents = F.round(F.col("price") * 100).cast("long") * (count + 1)
    return F.floor(cents / divisor).cast("string")


def qty_(name: str):
    return F.col(name).cast("double")


BOX = """
lnb AS (SELECT l.*, s_nationkey FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey),
side AS (
  SELECT l_orderkey AS game_id, l_linenumber % 2 AS home, arg_min(s_nationkey, l_linenumber * 100 + s_nationkey) AS nation,
    round(sum(l_extendedprice), 2) AS price, sum(l_quantity) AS qty,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS red_qty,
    round(sum(l_tax), 2) AS tax, round(sum(l_discount), 2) AS disc, count(*) AS n,
    count(*) FILTER (l_linestatus = 'O') AS n_open, count(*) FILTER (l_returnflag = 'A') AS n_a
  FROM lnb GROUP BY 1, 2),
ends AS (SELECT game_id, max(nation) FILTER (home = 1) AS h, max(nation) FILTER (home = 0) AS v0,
    max(price) FILTER (home = 1) AS hp, max(price) FILTER (home = 0) AS vp FROM side GROUP BY 1),
away AS (SELECT *, CASE WHEN h = v0 THEN (v0 + 1) % 25 ELSE v0 END AS v FROM ends),
pair2 AS (SELECT side.*, CASE WHEN home = 1 THEN h ELSE v END AS team_id,
    CASE WHEN vp IS NULL OR hp > vp OR (hp = vp AND h < v) THEN h ELSE v END AS winner FROM side JOIN away USING (game_id)),
box AS (
  SELECT game_id, team_id, n_name AS team_short_display_name, team_id = winner AS team_winner,
    price / 1000 AS team_score, 2 * qty AS field_goals_attempted, qty * (1 - disc / n) AS field_goals_made,
    red_qty AS three_point_field_goals_attempted, red_qty / 2 AS three_point_field_goals_made,
    100 * tax AS free_throws_attempted, 80 * tax * (1 - disc / n) AS free_throws_made,
    CAST(n_open + 1 AS DOUBLE) AS offensive_rebounds, CAST(n + 2 AS DOUBLE) AS defensive_rebounds,
    CAST(n + n_a AS DOUBLE) AS turnovers, CAST(n AS DOUBLE) AS assists,
    CASE WHEN n_a = 3 THEN 'n/a' ELSE CAST(CAST(round(price * 100) AS BIGINT) * (n_open + 1) // 2000000 AS VARCHAR) END AS points_in_paint,
    CASE WHEN n_a = 4 THEN '--' ELSE CAST(CAST(round(price * 100) AS BIGINT) * (n_a + 1) // 3000000 AS VARCHAR) END AS fast_break_points
  FROM pair2 JOIN nation ON team_id = n_nationkey)
"""


TITLES = {"1-URGENT": "Head Coach", "2-HIGH": "Associate Head Coach", "3-MEDIUM": "Assistant Coach"}
AS_OF = 2002


def first_supplier(spark: SparkSession, d: str) -> DataFrame:
    """Supplier of each order's lowest-numbered line.

    Line and supplier number are packed into one long, whose minimum is a hash
    aggregate; suppliers are joined to orders, not to their lines.
    """
    packed = F.min(F.col("l_linenumber").cast("long") * (1 << 48) + F.col("l_suppkey"))
    first = table(spark, d, "lineitem").groupBy("l_orderkey").agg(packed.alias("p"))
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    named = first.withColumn("s_suppkey", F.col("p").bitwiseAND(F.lit((1 << 48) - 1)))
    return named.join(sup, "s_suppkey").select("l_orderkey", "s_nationkey", "s_name")


def positions(spark: SparkSession, d: str) -> DataFrame:
    """One career row per order: coach = customer, school = first supplier's nation."""
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    title = F.lit("Staff")
    for priority, name in reversed(TITLES.items()):
        title = F.when(F.col("o_orderpriority") == priority, name).otherwise(title)
    year, key = F.year("o_orderdate"), F.col("o_orderkey")
    std = F.col("position_title_standardized")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.upper(std))
        .when(F.col("o_orderstatus") == "P", F.concat(std, F.lit(" & Recruiting Coordinator")))
        .otherwise(std)
    )
    return (
        table(spark, d, "orders")
        .join(first_supplier(spark, d), key == F.col("l_orderkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("position_title_standardized", title)
        .select(
            F.concat(F.lit("Coach "), F.col("o_custkey").cast("string")).alias("coach"),
            key.alias("seq"),
            F.col("s_name").alias("college"),
            F.col("n_name").alias("college_clean"),
            raw.alias("title"),
            std,
            F.when(key % 97 != 0, year).alias("start_year"),
            F.when(key % 7 != 0, (year + key % 4).cast("int")).alias("end_year"),
            F.when(F.col("n_nationkey") % 2 == 0, "I").otherwise("II").alias("division"),
            F.when(F.col("r_name") != "MIDDLE EAST", F.col("r_name")).alias("conference"),
        )
    )


POS = """
fs AS (SELECT l_orderkey, arg_min(s_nationkey, row(l_linenumber, l_suppkey)) AS nk, arg_min(s_name, row(l_linenumber, l_suppkey)) AS college
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
pos0 AS (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'Head Coach' WHEN '2-HIGH' THEN 'Associate Head Coach'
    WHEN '3-MEDIUM' THEN 'Assistant Coach' ELSE 'Staff' END AS std
  FROM orders JOIN fs ON o_orderkey = l_orderkey JOIN nation ON nk = n_nationkey JOIN region ON n_regionkey = r_regionkey),
pos AS MATERIALIZED (SELECT 'Coach ' || o_custkey AS coach, o_orderkey AS seq, college, n_name AS college_clean,
    CASE o_orderstatus WHEN 'F' THEN upper(std) WHEN 'P' THEN std || ' & Recruiting Coordinator' ELSE std END AS title,
    std AS position_title_standardized, CASE WHEN o_orderkey % 97 <> 0 THEN year(o_orderdate) END AS start_year,
    CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) + o_orderkey % 4 END AS end_year,
    CASE WHEN n_nationkey % 2 = 0 THEN 'I' ELSE 'II' END AS division,
    CASE WHEN r_name <> 'MIDDLE EAST' THEN r_name END AS conference FROM pos0)
"""


# texts of a side's totals from q (quantity), n (lines), r and a (flag R and A lines)
TOTAL_TEXTS = {
    "Fgam": ("{q}", "-", "{q2}"), "ShootingPercentage": ("{n}", "5.5%"), "Tpam": ("{r}", "-", "{n}"), "Tppercentage": ("{r}", "0.25%"),
    "Ftma": ("{a}", "-", "{n}"), "Ftp": ("{a}", "1%"), "TotalRebounds": ("{n}",), "OffensiveRebounds": ("{r}",), "DefensiveRebounds": ("{a}",),
    "Leads": ("{n}",), "TimeWithLead": ("0", "{n}", ":30"), "PercentLead": ("{n}", "%"), "LargestLead": ("{q}",),
    "LargestLeadScores": ("{q}", "-", "{n}"), "LargestLeadTime": ("05:1", "{a}", " 2nd"), "Assists": ("{a}",), "Turnovers": ("{r}",),
    "PointsFromBench": ("{q2}",), "Blocks": ("{a}",), "PointsOffFastBreak": ("{r}",), "Steals": ("{n}",), "PointsOffTurnovers": ("{r}",),
    "PointsInPaint": ("{q}",), "PointsOffSecondChance": ("{a}",), "PersonalFouls": ("{q}",), "TechnicalFouls": ("{r}",),
}


def game_docs(spark: SparkSession, d: str) -> DataFrame:
    """One nested document per order: lines are plays, odd lines the home side."""
    odd = F.col("l_linenumber") % 2 == 1
    side = F.when(odd, "HomeTeam").otherwise("VisitingTeam")
    flag = F.col("l_returnflag")
    play = F.struct(
        F.when(flag == "A", "LAYUP").when(flag == "N", "TURNOVER").otherwise("REBOUND").alias("Type"),
        F.when(F.col("l_linestatus") == "O", "GOOD").otherwise("MISS").alias("Action"),
        F.col("l_linenumber").alias("Period"),
        (F.col("l_quantity") * 10).cast("int").alias("ClockSeconds"),
        (F.col("l_partkey") * 1000 + F.col("l_linenumber")).alias("Id"),
        side.alias("Team"),
        F.when(F.col("l_tax") > 0.02, F.struct(side.alias("Team"), (F.col("l_suppkey") % 56).cast("string").alias("UniformNumber"))).alias("Player"),
    )
    sums = {}
    for name, here in (("home", odd), ("away", ~odd)):
        sums[f"{name}_q"] = F.sum(F.when(here, F.col("l_quantity")).otherwise(0)).cast("int")
        sums[f"{name}_n"] = F.count_if(here)
        sums[f"{name}_r"] = F.count_if(here & (flag == "R"))
        sums[f"{name}_a"] = F.count_if(here & (flag == "A"))
    for name, here in (("home", odd), ("away", ~odd)):
        listed = F.collect_list(F.when(here, F.struct(F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity"))))
        sums[f"{name}_players"] = F.transform(F.array_sort(listed), lambda x: F.create_map(
            F.lit("UniformNumber"), (x["l_suppkey"] % 56).cast("string"), F.lit("Points"), x["l_quantity"].cast("int").cast("string")))
    # an order has a handful of lines, so its list of plays is one small document
    dealt = table(spark, d, "lineitem").repartition(line_tasks(spark, d), "l_orderkey")
    per_game = dealt.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(play)).alias("Plays"), *[c.alias(n) for n, c in sums.items()]
    )

    def totals(name: str):
        parts = {k: F.col(f"{name}_{k}").cast("string") for k in "qnra"}
        parts["q2"] = (F.col(f"{name}_q") * 2).cast("string")
        pairs = []
        for key, pieces in TOTAL_TEXTS.items():
            text = F.concat(*[parts[p[1:-1]] if p.startswith("{") else F.lit(p) for p in pieces])
            pairs += [F.lit(key), text]
        n, q = F.col(f"{name}_n"), F.col(f"{name}_q")
        halves = [F.struct(F.create_map(F.lit("Points"), x.cast("string")).alias("Values")) for x in (q - n, n)]
        players = F.struct(F.struct(F.col(f"{name}_players").alias("Values")).alias("Players")).alias("PlayerGroups")
        return F.struct(F.struct(F.create_map(*pairs).alias("Values")).alias("Totals"), players, F.array(*halves).alias("PeriodStats"))

    def team(name: str, label):
        q, n = F.col(f"{name}_q"), F.col(f"{name}_n").cast("int")
        return F.struct(label.alias("Name"), q.alias("Score"), F.array(q - n, n).alias("PeriodScores"), F.array(n, n).alias("PeriodTimeouts"))

    g = games(spark, d).join(per_game, F.col("game_id") == F.col("l_orderkey"))
    officials = F.when(F.col("location") != "", F.array_join("officials", ",  ")).otherwise("")
    home_key = F.regexp_extract("home", r"(\d+)", 1).cast("int")
    named = lambda team, k: F.concat(team, F.lit(f" {k}"))
    leaders = F.struct(*[
        F.create_map(*[x for k in ("Points", "Rebounds", "Personal Fouls", "Usage Percentage") for x in (F.lit(k), named(F.col(team), k))]).alias(s)
        for s, team in (("HomeTeam", "home"), ("VisitingTeam", "visitor"))
    ])
    return g.select(
        home_key.alias("ncaa_id"),
        F.col("game_id").cast("string").alias("game_id"),
        F.struct(
            F.col("date").alias("Date"), F.col("start_time").alias("StartTime"), F.col("location").alias("Location"),
            officials.alias("Officials"), (F.col("home_q") * 100).alias("Attendance"),
            team("home", F.col("home")).alias("HomeTeam"), team("away", F.col("visitor")).alias("VisitingTeam"),
        ).alias("Game"),
        F.struct(totals("home").alias("HomeTeam"), totals("away").alias("VisitingTeam")).alias("Stats"),
        leaders.alias("Leaders"),
        "Plays",
    )


DOCS = GAMES + """, side AS (SELECT l_orderkey, CAST(sum(CASE WHEN l_linenumber % 2 = 1 THEN l_quantity ELSE 0 END) AS BIGINT) AS home_q,
    count(*) FILTER (l_linenumber % 2 = 1) AS home_n, count(*) FILTER (l_linenumber % 2 = 1 AND l_returnflag = 'R') AS home_r,
    count(*) FILTER (l_linenumber % 2 = 1 AND l_returnflag = 'A') AS home_a,
    CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END) AS BIGINT) AS away_q,
    count(*) FILTER (l_linenumber % 2 = 0) AS away_n, count(*) FILTER (l_linenumber % 2 = 0 AND l_returnflag = 'R') AS away_r,
    count(*) FILTER (l_linenumber % 2 = 0 AND l_returnflag = 'A') AS away_a FROM lineitem GROUP BY 1),
doc AS (SELECT * FROM games JOIN side ON game_id = l_orderkey),
plays AS (SELECT CAST(regexp_extract(home, '[0-9]+') AS BIGINT) AS ncaa_id, CAST(game_id AS VARCHAR) AS game_id, date,
    CASE WHEN l_linenumber % 2 = 1 THEN home ELSE visitor END AS team, CASE WHEN l_linenumber % 2 = 1 THEN visitor ELSE home END AS opponent,
    CASE l_returnflag WHEN 'A' THEN 'LAYUP' WHEN 'N' THEN 'TURNOVER' ELSE 'REBOUND' END AS type,
    CASE WHEN l_linestatus = 'O' THEN 'GOOD' ELSE 'MISS' END AS action, CAST(l_linenumber AS BIGINT) AS period,
    CAST(l_quantity * 10 AS BIGINT) AS seconds, CASE WHEN l_tax > 0.02 THEN CAST(l_suppkey % 56 AS VARCHAR) END AS uniform,
    l_partkey * 1000 + l_linenumber AS play_id
  FROM lineitem JOIN games ON l_orderkey = game_id)
"""


def event_plays(spark: SparkSession, d: str) -> DataFrame:
    """Events as plays: team = user modulus, action by value."""
    return table(spark, d, "events").select(
        F.col("event_id").alias("play_id"),
        (F.col("user_id") % 25).alias("ncaa_id"),
        F.concat(F.lit("Team "), (F.col("user_id") % 25).cast("string")).alias("team"),
        F.col("event_type").alias("type"),
        F.when(F.col("value") >= 20, "GOOD").otherwise("MISS").alias("action"),
        (F.floor(F.hour("ts") / 6) + 1).alias("period"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
