"""Lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.functions.strings import join_key
from rimsight.operators import lookups
from rimsight.operators.keyed import first_per_key
from rimsight.plans.registry import query
from rimsight.plans.standins import GAMES, POS, games, positions, table

COLLEGES_SQL = """colleges AS (SELECT s_name AS college, CASE WHEN s_acctbal > 0 THEN s_nationkey END AS ncaa_id,
    CASE WHEN s_acctbal > 9000 THEN '' ELSE 'Clean ' || s_name END AS college_clean,
    CASE WHEN s_acctbal > 5000 THEN 'NCAA_D1' ELSE 'Other' END AS category, s_suppkey AS ord FROM supplier WHERE s_acctbal > -500),
dir AS (SELECT n_nationkey AS ncaa_id, n_name AS team, 'ST' || n_nationkey AS team_state, r_name AS conference, 'I' AS division
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')"""


def colleges(spark, d):
    bal = F.col("s_acctbal")
    return table(spark, d, "supplier").where(bal > -500).select(
        F.col("s_name").alias("college"),
        F.when(bal > 0, F.col("s_nationkey")).alias("ncaa_id"),
        F.when(bal > 9000, "").otherwise(F.concat(F.lit("Clean "), "s_name")).alias("college_clean"),
        F.when(bal > 5000, "NCAA_D1").otherwise("Other").alias("category"),
        F.col("s_suppkey").alias("ord"),
    )


def directory(spark, d):
    joined = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.where(F.col("r_name") != "ASIA").select(
        F.col("n_nationkey").alias("ncaa_id"),
        F.col("n_name").alias("team"),
        F.concat(F.lit("ST"), F.col("n_nationkey").cast("string")).alias("team_state"),
        F.col("r_name").alias("conference"),
        F.lit("I").alias("division"),
    )


@query(
    "j9_cascading_lookup",
    f"""WITH {POS}, {COLLEGES_SQL}, by_id AS (SELECT ncaa_id, arg_min(category, ord) AS category FROM colleges WHERE ncaa_id IS NOT NULL GROUP BY 1)
    SELECT p.coach, p.seq, p.college, c.ncaa_id AS team_id, coalesce(t.team, nullif(c.college_clean, ''), p.college) AS college_clean,
      CASE WHEN t.team IS NOT NULL THEN coalesce(i.category, '') ELSE coalesce(c.category, '') END AS category,
      coalesce(t.team_state, '') AS team_state, coalesce(t.conference, '') AS conference, coalesce(t.division, '') AS division
    FROM pos p LEFT JOIN colleges c ON p.college = c.college LEFT JOIN by_id i ON c.ncaa_id = i.ncaa_id LEFT JOIN dir t ON c.ncaa_id = t.ncaa_id""",
)
def j9(spark, d):
    rows = positions(spark, d).select("coach", "seq", "college")
    return lookups.cascade(rows, colleges(spark, d), directory(spark, d))


@query(
    "j10_composite_lookup",
    f"""WITH {POS}, s AS (SELECT coach, college, title, CAST(start_year AS VARCHAR) AS s, CAST(end_year AS VARCHAR) AS e,
      arg_max(position_title_standardized, seq) AS std FROM pos WHERE division = 'I' GROUP BY ALL)
    SELECT p.seq, coalesce(s.std, '') AS std FROM pos p LEFT JOIN s ON p.coach = s.coach AND p.college = s.college AND p.title = s.title
      AND CAST(p.start_year AS VARCHAR) IS NOT DISTINCT FROM s.s AND CAST(p.end_year AS VARCHAR) IS NOT DISTINCT FROM s.e""",
)
def j10(spark, d):
    text = {c: F.col(c).cast("string") for c in ("start_year", "end_year")}
    rows = positions(spark, d).withColumns(text)
    keys = ["coach", "college", "title", "start_year", "end_year"]
    known = rows.where("division = 'I'").select(*keys, F.col("position_title_standardized").alias("std"), F.col("seq").alias("ord"))
    return lookups.composite_lookup(rows.select("seq", *keys), known, keys, "std", "ord").select("seq", "std")


LABELS_SQL = """lab AS (SELECT 'Coach ' || o_custkey AS coach, arg_max(CASE o_orderpriority WHEN '1-URGENT' THEN 'F' WHEN '2-HIGH' THEN 'M'
    WHEN '3-MEDIUM' THEN 'N' ELSE '' END, o_orderkey) AS g FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
lab2 AS (SELECT coach, nullif(g, '') AS gender FROM lab)"""


def coach_labels(spark, d):
    p = F.col("o_orderpriority")
    value = F.when(p == "1-URGENT", "F").when(p == "2-HIGH", "M").when(p == "3-MEDIUM", "N").otherwise("")
    orders = table(spark, d, "orders").where(F.col("o_orderstatus") != "P")
    return orders.select(F.concat(F.lit("Coach "), F.col("o_custkey").cast("string")).alias("coach"), value.alias("gender"), F.col("o_orderkey").alias("ord"))


def labelled(spark, d):
    rows = positions(spark, d).select("coach", "seq")
    joined = lookups.attribute_map(rows, coach_labels(spark, d), "coach", "gender", "ord")
    return joined.withColumn("gender", F.nullif("gender", F.lit("")))


@query(
    "j11_attribute_map",
    f"WITH {POS}, {LABELS_SQL} SELECT coach, seq, gender FROM pos LEFT JOIN lab2 USING (coach)",
)
def j11(spark, d):
    return labelled(spark, d)


@query(
    "j11_match_report",
    f"""WITH {POS}, {LABELS_SQL} SELECT count(*) AS total, count(gender) AS matched, count(*) - count(gender) AS unmatched,
      count(gender) * 100.0::DOUBLE / count(*) AS matched_pct FROM pos LEFT JOIN lab2 USING (coach)""",
    "matched_pct",
)
def j11_report(spark, d):
    return lookups.match_report(labelled(spark, d), "gender")


@query(
    "a39_label_distribution",
    f"WITH {POS}, {LABELS_SQL} SELECT coalesce(gender, 'None') AS label, count(*) AS n FROM pos LEFT JOIN lab2 USING (coach) GROUP BY 1",
)
def a39(spark, d):
    return lookups.label_counts(labelled(spark, d), "gender")


@query(
    "j12_override",
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'MOVED-' || c_nationkey ELSE c_mktsegment END AS conference FROM customer""",
)
def j12(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("conference"))
    return lookups.override(rows, moves(spark, d), "c_name", "conference", "new_conference").select("c_custkey", "c_name", "conference")


def moves(spark, d):
    gone = table(spark, d, "customer").where(F.col("c_acctbal") < 0)
    return gone.select("c_name", F.concat(F.lit("MOVED-"), F.col("c_nationkey").cast("string")).alias("new_conference"))


@query(
    "j12_override_changes",
    """SELECT c_name, c_mktsegment AS old, 'MOVED-' || c_nationkey AS new FROM customer WHERE c_acctbal < 0""",
)
def j12_changes(spark, d):
    rows = table(spark, d, "customer").select("c_name", F.col("c_mktsegment").alias("conference"))
    return lookups.override_changes(rows, moves(spark, d), "c_name", "conference", "new_conference")


NAMES_SQL = """espn AS (SELECT s_suppkey AS team_id, 'Ünï ' || s_name AS display FROM supplier),
csv AS (SELECT upper('uni ' || replace(s_name, '#', '-')) || '.' AS espn_name, 'C' || s_nationkey AS conference FROM supplier WHERE s_acctbal > 0),
ek AS (SELECT *, regexp_replace(lower(strip_accents(display)), '[^a-z0-9]', '', 'g') AS k FROM espn),
ck AS (SELECT *, regexp_replace(lower(strip_accents(espn_name)), '[^a-z0-9]', '', 'g') AS k FROM csv)"""


def name_tables(spark, d):
    sup = table(spark, d, "supplier")
    espn = sup.select(F.col("s_suppkey").alias("team_id"), F.concat(F.lit("Ünï "), "s_name").alias("display"))
    named = F.concat(F.upper(F.concat(F.lit("uni "), F.replace("s_name", F.lit("#"), F.lit("-")))), F.lit("."))
    csv = sup.where("s_acctbal > 0").select(
        named.alias("espn_name"), F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("conference")
    )
    return espn, csv


@query(
    "j3_normalised_name_join",
    f"WITH {NAMES_SQL} SELECT DISTINCT team_id, conference FROM ek JOIN ck USING (k)",
)
def j3(spark, d):
    espn, csv = name_tables(spark, d)
    joined = lookups.by_normal_name(espn, csv, join_key("display"), join_key("espn_name"), "left")
    kept = joined.where(F.col("conference").isNotNull()).select("team_id", "conference")
    return first_per_key(kept, ["team_id"], [F.col("conference")])


@query("j4_unmatched_names", f"WITH {NAMES_SQL} SELECT team_id, display FROM ek WHERE k NOT IN (SELECT k FROM ck)")
def j4(spark, d):
    espn, csv = name_tables(spark, d)
    return lookups.by_normal_name(espn, csv, join_key("display"), join_key("espn_name"), "left_anti")


@query("j5_matched_names", f"WITH {NAMES_SQL} SELECT team_id, display FROM ek WHERE k IN (SELECT k FROM ck)")
def j5(spark, d):
    espn, csv = name_tables(spark, d)
    return lookups.by_normal_name(espn, csv, join_key("display"), join_key("espn_name"), "left_semi")


@query(
    "j7_full_join_of_names",
    f"""WITH {GAMES}, a AS (SELECT DISTINCT home AS team FROM games WHERE location = 'ASIA'),
    b AS (SELECT DISTINCT visitor AS team FROM games WHERE location = '')
    SELECT coalesce(a.team, b.team) AS team, a.team IS NOT NULL AS at_home, b.team IS NOT NULL AS away FROM a FULL JOIN b ON a.team = b.team""",
)
def j7(spark, d):
    g = games(spark, d)
    a = g.where(F.col("location") == "ASIA").select(F.col("home").alias("team")).distinct().withColumn("at_home", F.lit(True))
    b = g.where(F.col("location") == "").select(F.col("visitor").alias("team")).distinct().withColumn("away", F.lit(True))
    no = F.lit(False)
    return a.join(b, "team", "full").select(
        "team", F.coalesce("at_home", no).alias("at_home"), F.coalesce("away", no).alias("away")
    ).orderBy("team")


@query(
    "j8_strict_double_lookup",
    """SELECT o_orderkey AS game_id, CAST(year(o_orderdate) AS BIGINT) AS year, o_custkey AS team_1_id, a.c_mktsegment AS team_1_region,
      CAST(a.c_nationkey AS BIGINT) AS team_1_seed, b.c_custkey AS team_2_id, b.c_mktsegment AS team_2_region, CAST(b.c_nationkey AS BIGINT) AS team_2_seed
    FROM orders JOIN customer a ON o_custkey = a.c_custkey JOIN customer b ON b.c_custkey = CASE WHEN o_custkey > 1 THEN o_custkey - 1 ELSE 2 END""",
)
def j8(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.year("o_orderdate").alias("year"),
        F.col("o_custkey").alias("team_1_id"),
        F.when(F.col("o_custkey") > 1, F.col("o_custkey") - 1).otherwise(2).alias("team_2_id"),
    )
    sides = F.array("team_1_id", "team_2_id")
    years = orders.select("year", F.explode(sides).alias("team_id"), F.col("game_id").alias("ord"))
    seeds = table(spark, d, "customer").select(
        F.col("c_custkey").alias("team_id"), F.col("c_mktsegment").alias("region"), F.col("c_nationkey").alias("seed")
    )
    return lookups.strict_sides(orders, years.join(seeds, "team_id"), "ord")


@query(
    "j14_three_way_join",
    """SELECT c_custkey AS person_id, c_name AS full_name, n_nationkey AS team_id, n_name AS team, count(*) AS seasons
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE year(o_orderdate) = 2000 AND o_orderstatus = 'F' GROUP BY ALL""",
)
def j14(spark, d):
    seasons = table(spark, d, "orders").where((F.year("o_orderdate") == 2000) & (F.col("o_orderstatus") == "F"))
    joined = (
        table(spark, d, "customer")
        .join(seasons, F.col("c_custkey") == F.col("o_custkey"))
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.groupBy(
        F.col("c_custkey").alias("person_id"), F.col("c_name").alias("full_name"), F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team")
    ).agg(F.count(F.lit(1)).alias("seasons"))


PLAYED = "played AS (SELECT 'Coach ' || c_custkey AS coach, n_name AS team FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def played(spark, d):
    joined = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(F.concat(F.lit("Coach "), F.col("c_custkey").cast("string")).alias("coach"), F.col("n_name").alias("team"))


@query(
    "j15_played_at",
    f"WITH {POS}, {PLAYED} SELECT DISTINCT coach FROM pos JOIN played USING (coach) WHERE team = 'NATION_3' ORDER BY 1",
)
def j15(spark, d):
    at = played(spark, d).where(F.col("team") == "NATION_3")
    return positions(spark, d).join(at, "coach").select("coach").distinct().orderBy("coach")


@query(
    "j15_played_and_coached",
    f"WITH {POS}, {PLAYED} SELECT DISTINCT coach, team AS college FROM pos JOIN played USING (coach) WHERE college_clean = team",
)
def j15_same(spark, d):
    joined = positions(spark, d).join(played(spark, d), "coach").where(F.col("college_clean") == F.col("team"))
    return joined.select("coach", F.col("team").alias("college")).distinct()


@query(
    "j17_resume_merge",
    """SELECT c_custkey, c_name, c_mktsegment AS segment, CASE WHEN c_acctbal > 0 THEN c_name || '@' || c_nationkey ELSE '' END AS positions,
      CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END::BIGINT AS n FROM customer""",
)
def j17(spark, d):
    cust = table(spark, d, "customer")
    bios = cust.select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    entry = F.array(F.concat_ws("@", "c_name", F.col("c_nationkey").cast("string")))
    prior = cust.where("c_acctbal > 0").select("c_name", F.col("c_mktsegment").alias("segment"), entry.alias("positions"))
    merged = lookups.resume(bios, prior, ["c_name", "segment"], ["positions"])
    return merged.select("c_custkey", "c_name", "segment", F.array_join("positions", ";").alias("positions"), F.size("positions").alias("n"))


@query("p15_unprocessed_rows", "SELECT c_custkey, c_name FROM customer WHERE NOT c_acctbal > 0")
def p15(spark, d):
    cust = table(spark, d, "customer")
    listed = cust.withColumn("positions", F.when(F.col("c_acctbal") > 0, F.array("c_name")).when(F.col("c_nationkey") > 9, F.array()))
    return lookups.unprocessed(listed, "positions").select("c_custkey", "c_name")


SIDE = """side AS (SELECT g.game_id, g.home, g.visitor, n_name AS team, CAST(n_nationkey AS BIGINT) AS team_id FROM games g
  JOIN orders ON o_orderkey = game_id JOIN nation ON n_nationkey = o_custkey % 25)"""


@query(
    "j18_name_containment",
    f"""WITH {GAMES}, {SIDE} SELECT game_id, team, CASE WHEN contains(home, team) THEN team_id END AS home_team_id,
      CASE WHEN NOT contains(home, team) AND contains(visitor, team) THEN team_id END AS visiting_team_id FROM side""",
)
def j18(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("game_id"), (F.col("o_custkey") % 25).alias("n_nationkey"))
    tracked = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("team"), F.col("n_nationkey").alias("team_id"))
    rows = games(spark, d).join(orders, "game_id").join(tracked, "n_nationkey")
    return lookups.side_by_containment(rows).select("game_id", "team", "home_team_id", "visiting_team_id")


@query(
    "j20_domain_overlap",
    f"""WITH {POS}, {PLAYED}, p AS (SELECT college_clean AS college, count(*) AS position_count FROM pos WHERE division = 'I' GROUP BY 1),
    e AS (SELECT team AS college, count(*) AS education_count FROM played GROUP BY 1) SELECT * FROM p JOIN e USING (college)""",
)
def j20(spark, d):
    left = positions(spark, d).where("division = 'I'").select(F.col("college_clean").alias("college"))
    return lookups.domain_overlap(left, played(spark, d).select(F.col("team").alias("college")), "college")
