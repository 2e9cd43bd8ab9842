"""Readers and writers, each a round trip of derived rows through files."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.functions.strings import map_values
from rimsight.operators import bios, plays
from rimsight.plans.registry import query
from rimsight.plans.sqltext import case_sql, quoted
from rimsight.plans.standins import DOCS, GAMES, POS, game_docs, games, positions, table
from rimsight.session import scratch_path
from rimsight.sinks import tables, writers
from rimsight.sources import readers, units
from rimsight.streaming import upsert


@query("s1_csv_rows_with_key", "SELECT page_id, url FROM pages WHERE url LIKE 'https%'")
def s1(spark, d):
    path = scratch_path(spark, "s1")
    url = F.when(F.col("url").startswith("https"), F.col("url"))
    writers.write_csv(table(spark, d, "pages").select("page_id", url.alias("url"), "html"), path, ["page_id", "url"])
    return readers.read_csv_rows(spark, path, "page_id long, url string", "url")


@query("s2_json_games", f"WITH {GAMES} SELECT game_id, home, visitor, total_fouls, len(officials) AS crew FROM games", "total_fouls")
def s2(spark, d):
    path = scratch_path(spark, "s2")
    writers.write_json(games(spark, d), path)
    return readers.read_games(spark, path).select("game_id", "home", "visitor", "total_fouls", F.size("officials").alias("crew"))


@query(
    "s3_many_seasons",
    f"WITH {GAMES} SELECT CAST(season AS VARCHAR) AS season, count(*) AS games, sum(total_fouls) AS fouls FROM games GROUP BY 1",
    "fouls",
)
def s3(spark, d):
    path = scratch_path(spark, "s3")
    g = games(spark, d)
    files = g.withColumn("file", F.concat(F.lit("officials_"), F.col("season").cast("string"))).drop("season")
    files.write.partitionBy("file").json(path)
    # every season that orders can fall in, and two that are not there and must be skipped
    wanted = [f"{path}/file=officials_{y}" for y in (*range(1990, 2000), *range(2000, 2010), 2050, 2051)]
    table_ = readers.read_seasons(spark, wanted)
    return table_.groupBy("season").agg(F.count(F.lit(1)).alias("games"), F.sum("total_fouls").alias("fouls"))


FIBA_SQL = """fb AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'afro' WHEN 'O' THEN 'world' ELSE 'asia' END AS event, '2019' AS year, o_orderkey, o_custkey,
    CAST(o_totalprice AS BIGINT) AS cents, strftime(o_orderdate, '%d%m') AS date FROM orders)"""


def write_box_scores(spark, d):
    path = scratch_path(spark, "box")
    event = F.when(F.col("o_orderstatus") == "F", "afro").when(F.col("o_orderstatus") == "O", "world").otherwise("asia")
    n = F.col("o_custkey").cast("string")
    cells = {
        "team1": F.lit("Slovak Republic"), "team2": F.lit("Mali"), "team1_score": n, "team2_score": F.lit("50"),
        "date": F.date_format("o_orderdate", "ddMM"), "number": F.concat(F.lit("0"), n), "player": F.concat(F.lit('Ann, "A" '), n),
        "minutes": F.format_string("%02d:30", F.col("o_custkey") % 40), "points": F.when(F.col("o_custkey") % 5 == 0, "DNP").otherwise(n),
        "fg": F.concat_ws("/", n, F.lit("99")),
    }
    blank = {c: F.lit("1/2") if c in ("fg2", "fg3", "ft") else F.lit("3") for c in readers.BOX_COLUMNS if c not in cells}
    wide = table(spark, d, "orders").select(
        *[{**cells, **blank}[c].alias(f"Raw {c}") for c in readers.BOX_COLUMNS],
        F.concat(event, F.lit("_2019_players_game_stats")).alias("file"),
    )
    wide.write.partitionBy("file").csv(path, header=True, escape='"')
    return path


@query(
    "s4_box_score_files",
    f"""WITH {FIBA_SQL} SELECT event, year, 'Ann, "A" ' || o_custkey AS player, o_custkey AS team1_score, date, o_custkey || '/99' AS fg, count(*) AS n FROM fb GROUP BY ALL""",
)
def s4(spark, d):
    rows = readers.read_box_scores(spark, write_box_scores(spark, d))
    event = F.replace("event", F.lit("file="), F.lit(""))
    return rows.groupBy(event.alias("event"), "year", "player", "team1_score", "date", "fg").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s10_typed_columns",
    f"""WITH {FIBA_SQL} SELECT '0' || o_custkey AS number, date, (o_custkey % 40) * 60 + 30 AS minutes, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS points, count(*) AS n
    FROM fb GROUP BY ALL""",
)
def s10(spark, d):
    rows = readers.read_box_scores(spark, write_box_scores(spark, d))
    return rows.groupBy("number", "date", "minutes", "points").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s5_account_lines",
    "SELECT o_orderkey AS id, lower(substr(o_orderpriority, 1, 1)) || '_account' AS account_name FROM orders WHERE o_orderpriority <> '3-MEDIUM'",
)
def s5(spark, d):
    path = scratch_path(spark, "s5")
    priority = F.col("o_orderpriority")
    name = F.when(priority == "3-MEDIUM", "teams").otherwise(F.concat(F.lower(F.substring(priority, 1, 1)), F.lit("_account")))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), name.alias("account"))
    rows.write.partitionBy("account").json(path)
    return readers.read_account_lines(spark, path, "id long")


def write_tree(spark, d):
    """Documents written under slug and season folders; their repeated names pack well, so files are compressed."""
    path = scratch_path(spark, "tree")
    year = F.substring("Game.Date", 1, 4).cast("int")
    season = F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))
    slug = F.concat_ws("-", F.col("ncaa_id").cast("string"), F.lower("Game.HomeTeam.Name"))
    docs = game_docs(spark, d).withColumn("slug", slug).withColumn("season", season)
    docs.write.partitionBy("slug", "season").json(path, compression="gzip")
    return path


def game_tree(spark, d):
    return readers.read_game_tree(spark, write_tree(spark, d), plays.GAME_SCHEMA)


TREE_KEYS = """CAST(game_id AS VARCHAR) AS game_id, regexp_extract(home, '[0-9]+') || '-' || lower(home) AS slug,
      season || '-' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS season"""


@query("s6_game_tree", f"WITH {GAMES} SELECT {TREE_KEYS} FROM games")
def s6(spark, d):
    return game_tree(spark, d).select("game_id", "slug", "season")


@query("s6_listed_tree", f"WITH {GAMES} SELECT {TREE_KEYS} FROM games")
def s6_listed(spark, d):
    """The same tree by a source that plans its tasks from the listing."""
    return units.game_units(spark, write_tree(spark, d), plays.GAME_SCHEMA).select("game_id", "slug", "season")


@query(
    "s5_line_positions",
    """SELECT lower(substr(o_orderpriority, 1, 1)) || '_account' AS account_name, count(*) AS lines, count(DISTINCT o_orderkey) AS ids, true AS places_are_whole
    FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1""",
)
def s5_positions(spark, d):
    """Every line of every account's files with its place; places run from 0 without gaps."""
    path = scratch_path(spark, "s5")
    priority = F.col("o_orderpriority")
    name = F.when(priority == "3-MEDIUM", "teams").otherwise(F.concat(F.lower(F.substring(priority, 1, 1)), F.lit("_account")))
    table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), name.alias("account")).write.partitionBy("account").json(path)
    files = units.account_units(spark, path, "id long").groupBy("account_name", "path").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("id").alias("ids"), (F.max("line") + 1).alias("top"), F.countDistinct("line").alias("places")
    )
    whole = F.min((F.col("top") == F.col("lines")) & (F.col("places") == F.col("lines")))
    return files.groupBy("account_name").agg(F.sum("lines").alias("lines"), F.sum("ids").alias("ids"), whole.alias("places_are_whole"))


@query(
    "s7_game_record",
    f"""WITH {DOCS} SELECT CAST(regexp_extract(home, '[0-9]+') AS BIGINT) AS ncaa_id, CAST(game_id AS VARCHAR) AS game_id, date, start_time, location,
      CASE WHEN location <> '' THEN array_to_string(officials, '|') ELSE '' END AS officials, home_q * 100 AS attendance, home, home_q AS home_score,
      (home_q - home_n) || '-' || home_n AS home_periods, 2 * home_n AS home_timeouts, visitor, away_q AS visitor_score, (away_q - away_n) || '-' || away_n AS visitor_periods,
      2 * away_n AS visitor_timeouts, """
    + ", ".join(
        f"{team} || ' {k}' AS {side}_leader_{c}" if k in ("Points", "Rebounds", "Personal Fouls", "Usage Percentage") else f"CAST(NULL AS VARCHAR) AS {side}_leader_{c}"
        for side, team in (("home", "home"), ("visitor", "visitor"))
        for k, c in plays.LEADERS.items()
    )
    + ", home_n + away_n AS plays FROM doc",
)
def s7(spark, d):
    return plays.game_record(game_tree(spark, d))


SIDES_SQL = """(SELECT *, home AS team, 'HomeTeam' AS side, home_q AS q, home_n AS n, 1 AS odd FROM doc
    UNION ALL SELECT *, visitor, 'VisitingTeam', away_q, away_n, 0 FROM doc)"""


@query(
    "s7_player_rows",
    f"""WITH {DOCS} SELECT CAST(regexp_extract(home, '[0-9]+') AS BIGINT) AS ncaa_id, CAST(game_id AS VARCHAR) AS game_id, side, team,
      row_number() OVER (PARTITION BY game_id, side ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS number,
      CAST(l_suppkey % 56 AS VARCHAR) AS "UniformNumber", CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "Points", CAST(NULL AS VARCHAR) AS "Assists"
    FROM {SIDES_SQL} d JOIN lineitem l ON l.l_orderkey = d.game_id AND l_linenumber % 2 = odd""",
)
def s7_players(spark, d):
    return plays.player_rows(game_tree(spark, d), ["UniformNumber", "Points", "Assists"])


@query(
    "s7_period_rows",
    f"""WITH {DOCS} SELECT CAST(regexp_extract(home, '[0-9]+') AS BIGINT) AS ncaa_id, CAST(game_id AS VARCHAR) AS game_id, side, team, number,
      CAST(CASE number WHEN 1 THEN q - n ELSE n END AS VARCHAR) AS "Points" FROM {SIDES_SQL}, (VALUES (1::BIGINT), (2)) p(number)""",
)
def s7_periods(spark, d):
    return plays.period_rows(game_tree(spark, d), ["Points"])


FEED_SQL = {
    "Game ID": "CAST(o_orderkey AS VARCHAR)", "Status Code": "'VALID'", "Team A ID": "CASE WHEN o_custkey = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END",
    "Team A Code": "CASE WHEN c_nationkey = 3 THEN '' ELSE 'N' || c_nationkey END", "Team B Code": "'B'", "Team A Score": "CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)",
    "Game Date Time": "CASE WHEN c_acctbal > 5000 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00') END", "Round Name": "o_orderpriority",
    "Competition Official Name": "'Cup ' || c_mktsegment", "Competition Gender": "'Women'", "Competition Zone Code": "'Z' || c_nationkey",
    "Competition Category Name": "c_mktsegment",
}
FEED_ROWS = "FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'"


def feed(spark, d):
    path = scratch_path(spark, "feed")
    nation = F.col("c_nationkey").cast("string")
    stamp = F.when(F.col("c_acctbal") > 5000, F.lit(None).cast("string")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    side = F.struct(F.col("o_custkey").alias("teamId"), F.when(F.col("c_nationkey") == 3, "").otherwise(F.concat(F.lit("N"), nation)).alias("code"))
    rows = joined.select(
        F.col("o_orderkey").alias("gameId"),
        F.when(F.col("o_orderstatus") == "P", "DRAFT").otherwise("VALID").alias("statusCode"),
        side.alias("teamA"),
        F.struct(F.lit("B").alias("code")).alias("teamB"),
        F.floor("o_totalprice").alias("teamAScore"),
        stamp.alias("gameDateTime"),
        F.struct(F.col("o_orderpriority").alias("roundName")).alias("round"),
        F.struct(
            F.concat(F.lit("Cup "), "c_mktsegment").alias("officialName"),
            F.when(F.col("o_orderpriority") == "5-LOW", "Men").otherwise("Women").alias("gender"),
            F.struct(F.concat(F.lit("Z"), nation).alias("zoneCode")).alias("zoneInformation"),
            F.struct(F.col("c_mktsegment").alias("name")).alias("competitionCategory"),
        ).alias("competition"),
    )
    writers.write_json(rows, path)
    return readers.flat_feed(readers.read_feed(spark, path))


@query(
    "s8_flat_feed",
    "SELECT " + ", ".join(f"{FEED_SQL.get(n, quoted(''))} AS \"{n}\"" for n in readers.FEED_FIELDS) + f" {FEED_ROWS}",
)
def s8(spark, d):
    return feed(spark, d)


@query(
    "p11_game_list",
    f"""SELECT {FEED_SQL['Game ID']} AS game_id, {FEED_SQL['Competition Official Name']} AS competition_name, {FEED_SQL['Team A Code']} AS team_a_code, 'B' AS team_b_code,
      CASE WHEN c_acctbal > 5000 THEN '2025' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year, {FEED_SQL['Game Date Time']} AS game_date_time {FEED_ROWS} AND c_nationkey <> 3""",
)
def p11(spark, d):
    return readers.game_list(feed(spark, d))


RATINGS_SQL = """WITH e AS (SELECT *, day(ts) % 4 = 0 AS wide, strftime(ts, '%Y-%m-%d') AS date, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY event_id DESC) AS r FROM events)
    SELECT CASE WHEN event_type = 'error' THEN 'T' ELSE '' END || user_id AS rank, event_type AS program, CASE WHEN user_id % 5 = 0 THEN '' ELSE 'N' || user_id END AS network,
      CASE WHEN event_type = 'click' THEN '' ELSE '8p' END AS time, '60' AS duration, '0.5' AS rating,
      CASE WHEN wide THEN '1,234' WHEN user_id % 7 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS viewers, date, CAST(NULL AS BIGINT) AS program_int, CAST(NULL AS BIGINT) AS network_int,
      CAST(NULL AS BIGINT) AS time_int, 60::BIGINT AS duration_int, CAST(NULL AS BIGINT) AS rating_int, CASE WHEN NOT wide AND user_id % 7 > 0 THEN event_id END AS viewers_int FROM e"""


def rating_days(spark, d):
    """One file of cells for each day, written and read back; every fourth day of a month has the wide table, cells may be blank."""
    who = F.col("user_id").cast("string")
    rank = F.when(F.col("event_type") == "error", F.concat(F.lit("T"), who)).otherwise(who)
    network = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.concat(F.lit("N"), who))
    six = [rank, F.col("event_type"), network, F.when(F.col("event_type") == "click", "").otherwise("8p"), F.lit("60"), F.lit("0.5")]
    narrow = [*six, F.when(F.col("user_id") % 7 == 0, "").otherwise(F.col("event_id").cast("string"))]
    wide = [*six, *[F.when(F.col("user_id") % 3 == i % 3, "").otherwise(f"x{i}") for i in range(10)], F.lit("1,234")]
    path = scratch_path(spark, "ratings")
    is_wide = F.dayofmonth("ts") % 4 == 0
    for cells, kept in ((narrow, ~is_wide), (wide, is_wide)):
        rows = table(spark, d, "events").where(kept).select(
            F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").alias("pos"), *[c.alias(f"c{i}") for i, c in enumerate(cells)]
        )
        rows.write.mode("append").partitionBy("day").csv(path, header=True, escape='"')
    return readers.read_rating_days(spark, path)


@query("s9_daily_ratings", RATINGS_SQL)
def s9(spark, d):
    return readers.daily_ratings(rating_days(spark, d))


@query("s9_daily_ratings_last_rows", RATINGS_SQL + " WHERE r <= 150")
def s9_last(spark, d):
    return readers.daily_ratings(rating_days(spark, d), kept=150)


@query("s11_required_columns", "SELECT o_orderkey, o_custkey FROM orders")
def s11(spark, d):
    return readers.require_columns(table(spark, d, "orders"), ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


@query("k1_csv_fixed_fields", f"WITH {POS} SELECT seq, coach, title FROM pos")
def k1(spark, d):
    path = scratch_path(spark, "k1")
    writers.write_csv(positions(spark, d), path, ["coach", "title", "seq"])
    return spark.read.schema("coach string, title string, seq long").csv(path, header=True, enforceSchema=False, escape='"')


@query("k2_json_records", "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def k2(spark, d):
    path = scratch_path(spark, "k2")
    writers.write_json(table(spark, d, "documents").select("doc_id", "text", "lang"), path)
    back = spark.read.schema("doc_id long, text string, lang string").json(path)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


def coach_docs(spark, d):
    """Two documents per coach in order: the later one replaces the first."""
    joined = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    url = F.concat(F.lit("u"), F.col("c_custkey").cast("string"))
    n = F.col("c_nationkey")

    def doc(batch, title):
        place = F.struct(F.concat(F.lit("C"), n.cast("string")).alias("college"), F.lit(title).alias("title"), (n + 1990).alias("start_year"))
        return joined.select(
            url.alias("url"), F.col("c_name").alias("name"), F.lit(batch).alias("batch"),
            F.array_repeat(place, n % 3).alias("positions"),
            F.array(F.struct(F.col("c_mktsegment").alias("college"), F.lit("Bachelors").alias("degree"))).alias("education"),
            F.when(n > 10, F.array(F.struct(F.lit(title).alias("team")))).otherwise(F.array().cast("array<struct<team:string>>")).alias("playing_career"),
        )

    return doc(1, "Old").unionByName(doc(2, "New"))


K4_SQL = """SELECT 'positions' AS kind, 'u' || c_custkey AS url, 'New' AS detail, count(*) AS n FROM customer, generate_series(1, c_nationkey % 3) GROUP BY 1, 2, 3
    UNION ALL SELECT 'education', 'u' || c_custkey, c_mktsegment, 1 FROM customer
    UNION ALL SELECT 'playing_career', 'u' || c_custkey, 'New', 1 FROM customer WHERE c_nationkey > 10
    UNION ALL SELECT 'coaches', 'u' || c_custkey, c_name, 1 FROM customer"""


@query("k4_child_tables", K4_SQL)
def k4(spark, d):
    path = scratch_path(spark, "k4")
    writers.write_child_tables(coach_docs(spark, d), "batch", path)
    return child_rows(lambda kind: spark.read.parquet(f"{path}/{kind}"))


def child_rows(read):
    parts = []
    for kind, key, detail in (("positions", "coach_url", "title"), ("education", "coach_url", "college"), ("playing_career", "coach_url", "team"), ("coaches", "url", "name")):
        rows = read(kind)
        parts.append(rows.groupBy(F.lit(kind).alias("kind"), F.col(key).alias("url"), F.col(detail).alias("detail")).agg(F.count(F.lit(1)).alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("k4_tables_at_once", K4_SQL)
def k4_at_once(spark, d):
    """All child tables in one pass over the documents, visible together."""
    path = scratch_path(spark, "k4")
    tables.write_tables(tables.coach_tables(coach_docs(spark, d), "batch"), path)
    return child_rows(lambda kind: tables.read_table(spark, path, kind))


@query(
    "k3_streaming_upsert",
    """SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1""",
)
def k3_stream(spark, d):
    """Orders arrive as a stream of files and are merged by customer, the latest order winning."""
    source, target, marks = (scratch_path(spark, n) for n in ("arrivals", "merged", "marks"))
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    rows.sort("o_orderkey").write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(source)
    # files written side by side arrive in any order, so the order's number decides, not the batch
    running = upsert.upsert_stream(stream, target, ["o_custkey"], "o_orderkey", marks, by_batch=False)
    running.awaitTermination()
    return upsert.current(spark, target).drop("_batch")


@query(
    "f25_country_names_both_sides",
    f"WITH {FIBA_SQL} SELECT event, {case_sql(quoted('Slovak Republic'), bios.COUNTRY_NAMES, quoted('x'))} AS team1, 'Mali' AS team2, count(*) AS n FROM fb GROUP BY ALL",
)
def f25_both(spark, d):
    rows = readers.read_box_scores(spark, write_box_scores(spark, d))
    named = rows.withColumns({c: map_values(F.col(c), bios.COUNTRY_NAMES) for c in ("team1", "team2")})
    event = F.replace("event", F.lit("file="), F.lit("")).alias("event")
    return named.groupBy(event, "team1", "team2").agg(F.count(F.lit(1)).alias("n"))
