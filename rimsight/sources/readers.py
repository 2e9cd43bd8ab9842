"""Readers of season files, game trees, feeds and box scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimsight.functions.strings import clock_seconds, falsy_blank, or_blank
from rimsight.functions.urls import event_and_year

SEASON_SCHEMA = (
    "game_id long, date string, start_time string, location string, home string, visitor string, home_fouls double, "
    "visitor_fouls double, home_technicals long, visitor_technicals long, officials array<string>"
)
# fixed values: the columns of a box-score file, in file order
BOX_COLUMNS = [
    "team1", "team2", "team1_score", "team2_score", "date", "number", "player", "minutes", "points", "fg", "fg2", "fg3", "ft",
    "offensive_rebounds", "defensive_rebounds", "rebounds", "assists", "fouls", "turnovers", "steals", "blocks", "plus_minus", "efficiency",
]
BOX_NUMBERS = ["team1_score", "team2_score", "points"] + BOX_COLUMNS[13:]


class MissingInput(ValueError):
    """Nothing could be loaded, or required columns are missing."""


def unit_name(path: Column) -> Column:
    """Name of the file a row came from, or of the folder Spark wrote it in."""
    pattern = r"/(?:[^/=]+=)?([^/]+?)(?:\.(?:json|csv))?(?:/part-[^/]*)?$"
    return F.regexp_extract(path, pattern, 1)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingInput(f"missing columns: {', '.join(missing)}")
    return df


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist on their own file systems."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            found.append(path)
    return found


def read_csv_rows(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """CSV with a header; rows without the key field are dropped."""
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=True, multiLine=False, escape='"')
    return rows.where(F.coalesce(F.col(key), F.lit("")) != "")


def read_games(spark: SparkSession, path: str, multi_line: bool = False, schema: str = SEASON_SCHEMA) -> DataFrame:
    """Game records with the total of both sides' fouls."""
    rows = spark.read.schema(schema).json(path, multiLine=multi_line)
    return rows.withColumn("total_fouls", F.col("home_fouls") + F.col("visitor_fouls"))


def read_seasons(spark: SparkSession, paths: Sequence[str], multi_line: bool = False, schema: str = SEASON_SCHEMA) -> DataFrame:
    """Many season files in one scan; season = text after the last '_' of the name."""
    present = existing(spark, paths)
    if not present:
        raise MissingInput("no data files could be loaded")
    rows = spark.read.schema(schema).json(present, multiLine=multi_line)
    season = F.substring_index(unit_name(F.col("_metadata.file_path")), "_", -1)
    return rows.select("*", season.alias("season")).withColumn("total_fouls", F.col("home_fouls") + F.col("visitor_fouls"))


def read_box_scores(spark: SparkSession, path: str) -> DataFrame:
    """Box-score files under fixed column names, with their event and year."""
    schema = ", ".join(f"`{c}` string" for c in BOX_COLUMNS)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).csv(
        path, header=True, enforceSchema=True, escape='"'
    )
    event, year = event_and_year(F.col("_metadata.file_path"))
    named = rows.select(event.alias("event"), year.alias("year"), "*")
    return typed_box_scores(named)


def typed_box_scores(rows: DataFrame) -> DataFrame:
    """Numbers cast, shirt number and date kept as text, minutes as seconds."""
    return rows.withColumns({c: F.col(c).try_cast("int") for c in BOX_NUMBERS}).withColumn("minutes", clock_seconds("minutes"))


def read_account_lines(spark: SparkSession, path: str, schema: str, skip: str = "teams") -> DataFrame:
    """JSON lines of many accounts; the account is the file's name, ``skip`` left out."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    account = unit_name(F.col("_metadata.file_path"))
    return rows.select("*", account.alias("account_name")).where(F.col("account_name") != skip)


def read_game_tree(spark: SparkSession, root: str, schema: str, null_bytes: int = 4) -> DataFrame:
    """Games under ``slug/season/``: JSON files only, plain or compressed, null files skipped, keys from the path."""
    rows = (
        spark.read.schema(f"{schema}, _bad string")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{json,json.gz}")
        .json(root)
        .where(F.col("_metadata.file_size") > null_bytes)
        # a compressed null file is larger than its text
        .where(~F.col("_metadata.file_path").endswith(".gz") | (F.coalesce(F.trim("_bad"), F.lit("")) != "null"))
    )
    keys = r"/(?:slug=)?([^/]+)/(?:season=)?(\d{4}-\d{2})/[^/]+$"
    path = F.col("_metadata.file_path")
    return rows.select("*", F.regexp_extract(path, keys, 1).alias("slug"), F.regexp_extract(path, keys, 2).alias("season")).drop("_bad")


# fixed values: output column and place in the tournament feed
FEED_FIELDS = {
    "Game ID": "gameId", "Game Name": "gameName", "Game Number": "gameNumber", "Status Code": "statusCode",
    "Team A ID": "teamA.teamId", "Team A Organisation ID": "teamA.organisationId", "Team A Code": "teamA.code",
    "Team A Official Name": "teamA.officialName", "Team A Short Name": "teamA.shortName",
    "Team B ID": "teamB.teamId", "Team B Organisation ID": "teamB.organisationId", "Team B Code": "teamB.code",
    "Team B Official Name": "teamB.officialName", "Team B Short Name": "teamB.shortName",
    "Team A Score": "teamAScore", "Team B Score": "teamBScore", "Is Live": "isLive", "Current Period": "currentPeriod",
    "Chrono": "chrono", "Live Game Status": "liveGameStatus", "Current Period Status": "currentPeriodStatus",
    "Host City": "hostCity", "Host Country": "hostCountry", "Host Country Code": "hostCountryCode", "Venue ID": "venueId",
    "Venue Name": "venueName", "Game Date Time": "gameDateTime", "Game Date Time UTC": "gameDateTimeUTC",
    "Has Time Game Date Time": "hasTimeGameDateTime", "IANA Time Zone": "ianaTimeZone", "UTC Offset": "utcOffset",
    "Is Postponed": "isPostponed", "Is Played Behind Closed Doors": "isPlayedBehindClosedDoors", "Venue Capacity": "venueCapacity",
    "Spectators": "spectators", "Statistic System": "statisticSystem", "Group ID": "groupId", "Group Pairing Code": "groupPairingCode",
    "Round ID": "round.roundId", "Round Code": "round.roundCode", "Round Name": "round.roundName", "Round Number": "round.roundNumber",
    "Round Type": "round.roundType", "Round Status Code": "round.roundStatusCode", "Competition ID": "competition.competitionId",
    "Competition Code": "competition.competitionCode", "Competition Official Name": "competition.officialName",
    "Competition Start": "competition.start", "Competition End": "competition.end", "Competition Status": "competition.status",
    "Competition Age Category": "competition.ageCategory", "Competition Gender": "competition.gender",
    "Competition FIBA Zone": "competition.fibaZone", "Competition Zone Code": "competition.zoneInformation.zoneCode",
    "Competition Type": "competition.competitionType", "Competition Category Code": "competition.competitionCategory.code",
    "Competition Category Name": "competition.competitionCategory.name",
}


def feed_schema() -> T.StructType:
    """Nested schema of the feed, every leaf as text."""
    tree: dict = {}
    for place in FEED_FIELDS.values():
        node = tree
        *parents, leaf = place.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = None

    def build(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, T.StringType() if v is None else build(v)) for k, v in node.items()])

    return build(tree)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(feed_schema()).json(path)


def flat_feed(feed: DataFrame) -> DataFrame:
    """Flat columns, missing as '', valid women's games only."""
    cells = [(falsy_blank(p) if "." in p else or_blank(p)).alias(n) for n, p in FEED_FIELDS.items()]
    return feed.select(*cells).where((F.col("`Status Code`") == "VALID") & (F.col("`Competition Gender`") == "Women"))


def game_list(flat: DataFrame, default_year: str = "2025") -> DataFrame:
    """Games with all keys, year from the timestamp, newest first."""
    keys = ["Game ID", "Competition Official Name", "Team A Code", "Team B Code"]
    kept = flat
    for k in keys:
        kept = kept.where(F.coalesce(F.col(f"`{k}`"), F.lit("")) != "")
    stamp = F.nullif(F.col("`Game Date Time`"), F.lit(""))
    return kept.select(
        F.col("`Game ID`").alias("game_id"),
        F.col("`Competition Official Name`").alias("competition_name"),
        F.col("`Team A Code`").alias("team_a_code"),
        F.col("`Team B Code`").alias("team_b_code"),
        F.coalesce(F.substring(stamp, 1, 4), F.lit(default_year)).alias("year"),
        F.coalesce(stamp, F.lit("")).alias("game_date_time"),
    ).orderBy(F.desc("game_date_time"), "game_id")


RATING_COLUMNS = ["rank", "program", "network", "time", "duration", "rating", "viewers"]


def daily_ratings(rows: DataFrame, kept: int | None = None, wide: int = 17) -> DataFrame:
    """Rows of each day (``date``, ``pos``, ``cells``) as seven text columns.

    Wide rows keep their first six cells and the last. Every cell after the first is also
    given as a whole number where it is one (``..._int``, else null). ``kept`` drops all but
    the last rows of a day; the row-number filter trims each task before the shuffle.
    """
    from pyspark.sql import Window

    if kept is not None:
        order = Window.partitionBy("date").orderBy(F.desc("pos"))
        rows = rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= kept)
    cells = F.when(F.size("cells") == wide, F.concat(F.slice("cells", 1, 6), F.slice("cells", wide, 1))).otherwise(F.col("cells"))
    shaped = rows.withColumn("cells", cells)
    columns = [F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(RATING_COLUMNS)]
    whole = [F.expr(f"try_cast(trim({c}) AS bigint)").alias(f"{c}_int") for c in RATING_COLUMNS[1:]]
    return shaped.select(*columns, "date").select("*", *whole)


def read_rating_days(spark: SparkSession, path: str, wide: int = 17) -> DataFrame:
    """Day files of table rows (header, then cells) as date, pos and cells; the date is in the file's name.

    A day has as many cells as its header names; blank cells keep their place as ''.
    """
    names = [f"c{i}" for i in range(wide)]
    day = F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})", 1).alias("date")
    read = spark.read.csv(path, schema=", ".join(["pos long", *(f"{c} string" for c in names)]), header=True, escape='"', enforceSchema=True)
    rows = read.select(day, "pos", F.array(*[F.coalesce(c, F.lit("")) for c in names]).alias("cells"))
    heads = spark.read.text(path).where(F.col("value").startswith("pos,")).select(day, (F.size(F.split("value", ",")) - 1).alias("width"))
    widths = heads.groupBy("date").agg(F.max("width").alias("width"))
    return rows.join(widths, "date").select("date", "pos", F.slice("cells", F.lit(1), F.col("width")).alias("cells"))
