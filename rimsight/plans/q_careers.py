"""Coaching careers."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.operators import careers, ranking
from rimsight.plans.registry import query
from rimsight.plans.standins import AS_OF, POS, positions
from rimsight.session import hold

PROGRAMS = ["NATION_0", "NATION_4", "NATION_8", "NATION_12"]
PROGRAM_SQL = ", ".join(f"'{p}'" for p in PROGRAMS)
ASSIST = "position_title_standardized IN ('Assistant Coach', 'Associate Head Coach')"
BEFORE = (
    POS
    + """, hc AS (SELECT coach, min(start_year) FILTER (position_title_standardized = 'Head Coach') AS first_hc_year
    FROM pos GROUP BY 1 HAVING bool_or(position_title_standardized = 'Head Coach' AND division = 'I')),
flag AS (SELECT pos.*, first_hc_year, start_year IS NOT NULL AND (first_hc_year IS NULL OR start_year < first_hc_year) AS before_hc
  FROM pos JOIN hc USING (coach)),
app AS MATERIALIZED (SELECT * FROM flag WHERE before_hc AND division = 'I')"""
)


@query("w9_first_head_year", f"WITH {BEFORE} SELECT seq, coach, first_hc_year, before_hc FROM flag")
def w9(spark, d):
    return careers.before_head(positions(spark, d)).select("seq", "coach", "first_hc_year", "before_hc")


@query("w10_rows_before_head", f"WITH {BEFORE} SELECT seq, coach, college_clean FROM app")
def w10(spark, d):
    return careers.apprentice_rows(positions(spark, d)).select("seq", "coach", "college_clean")


PROD = BEFORE + """, prod AS (SELECT college_clean, position_title_standardized, count(DISTINCT coach) AS future_hcs FROM app GROUP BY 1, 2)"""


@query("a19_head_coach_production", f"WITH {PROD} SELECT * FROM prod")
def a19(spark, d):
    return careers.production(positions(spark, d))


@query(
    "a19_production_totals",
    f"WITH {PROD} SELECT college_clean, CAST(sum(future_hcs) AS BIGINT) AS total_future_hcs FROM prod GROUP BY 1",
)
def a19_totals(spark, d):
    return careers.production_totals(careers.production(positions(spark, d)))


@query(
    "a20_top_schools_per_title",
    f"""WITH {PROD} SELECT college_clean, position_title_standardized, future_hcs FROM (
      SELECT *, rank() OVER (PARTITION BY position_title_standardized ORDER BY future_hcs DESC) AS r FROM prod WHERE {ASSIST}) WHERE r <= 10""",
)
def a20(spark, d):
    return careers.production_leaders(careers.production(positions(spark, d)), 10)


LADDER = BEFORE + """, lad AS (SELECT coach, count(*) AS n_positions, arg_max(position_title_standardized, row(start_year, seq)) AS final_position,
  string_agg(position_title_standardized, ' → ' ORDER BY start_year, seq) AS pathway FROM app GROUP BY 1)"""


@query("a21_career_ladders", f"WITH {LADDER} SELECT coach, n_positions, final_position, pathway AS positions_held FROM lad")
def a21(spark, d):
    return careers.ladders(positions(spark, d))


@query(
    "a21_final_position_frequency",
    f"""WITH {LADDER} SELECT final_position, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM lad) AS pct,
      (SELECT avg(n_positions) FROM lad) AS mean_positions FROM lad GROUP BY 1""",
    "pct mean_positions",
)
def a21_final(spark, d):
    ladders = hold(careers.ladders(positions(spark, d)))
    mean = ladders.agg(F.avg("n_positions").alias("mean_positions"))
    return careers.frequency(ladders, "final_position").crossJoin(F.broadcast(mean))


@query(
    "a22_pathways",
    f"""WITH {LADDER} SELECT * FROM (SELECT n_positions, pathway, count(*) AS n FROM lad WHERE n_positions IN (2, 3) GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY n_positions ORDER BY n DESC, pathway) <= 10""",
)
def a22(spark, d):
    from pyspark.sql import Window

    table = careers.pathways(positions(spark, d))
    order = Window.partitionBy("n_positions").orderBy(F.desc("n"), "pathway")
    return table.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= 10).drop("_r")


def schools(spark, d):
    """Positions by single suppliers as schools, so schools multiply with the data."""
    return positions(spark, d).withColumn("college_clean", F.col("college"))


LINKS = (
    BEFORE
    + f""", d1hc AS (SELECT DISTINCT coach FROM pos WHERE division = 'I' AND position_title_standardized = 'Head Coach'),
links AS MATERIALIZED (SELECT DISTINCT a.coach, h.coach AS hc_name, a.college AS college_clean FROM pos a JOIN pos h ON a.college = h.college
  AND a.coach <> h.coach AND a.start_year <= coalesce(h.end_year, {AS_OF}) AND coalesce(a.end_year, {AS_OF}) >= h.start_year
  WHERE a.division = 'I' AND h.division = 'I' AND h.position_title_standardized = 'Head Coach' AND a.{ASSIST}),
men AS (SELECT hc_name AS mentor, count(*) AS proteges_who_became_hc FROM links WHERE coach IN (SELECT coach FROM d1hc) GROUP BY 1)"""
)


@query("j6_mentor_overlap", f"WITH {LINKS} SELECT * FROM links")
def j6(spark, d):
    return careers.mentor_links(schools(spark, d), AS_OF)


@query("a23_mentors", f"WITH {LINKS} SELECT * FROM men ORDER BY proteges_who_became_hc DESC, mentor LIMIT 20")
def a23(spark, d):
    table = hold(schools(spark, d))
    people = careers.mentors(careers.mentor_links(table, AS_OF), table)
    return people.orderBy(F.desc("proteges_who_became_hc"), "mentor").limit(20)


@query(
    "a23_mentor_edges",
    f"""WITH {LINKS}, top AS (SELECT mentor FROM men ORDER BY proteges_who_became_hc DESC, mentor LIMIT 15)
    SELECT hc_name AS "from", coach AS "to", college_clean AS school FROM links
    WHERE hc_name IN (SELECT mentor FROM top) AND coach IN (SELECT coach FROM d1hc)""",
)
def a23_edges(spark, d):
    table = hold(schools(spark, d))
    return careers.mentor_edges(hold(careers.mentor_links(table, AS_OF)), table, 15)


MOVES = (
    POS
    + """, nxt AS (SELECT *, lead(college_clean) OVER w AS next_school, lead(position_title_standardized) OVER w AS next_position,
    lead(start_year) OVER w AS next_start FROM pos WHERE division = 'I' WINDOW w AS (PARTITION BY coach ORDER BY start_year NULLS LAST, seq)),
moves AS MATERIALIZED (SELECT * FROM nxt WHERE next_school IS NOT NULL AND college_clean <> next_school)"""
)


@query("w5_next_position", f"WITH {MOVES} SELECT seq, coach, next_school, next_position, next_start FROM nxt")
def w5(spark, d):
    take = {"college_clean": "next_school", "position_title_standardized": "next_position", "start_year": "next_start"}
    return careers.with_next(careers.division_one(positions(spark, d)), take).select(
        "seq", "coach", "next_school", "next_position", "next_start"
    )


@query(
    "a24_school_routes",
    f"WITH {MOVES} SELECT college_clean AS from_school, next_school AS to_school, count(*) AS coaches FROM moves GROUP BY 1, 2",
)
def a24(spark, d):
    return careers.routes(careers.movements(positions(spark, d)))


@query(
    "a25_exports_to_head",
    f"WITH {MOVES} SELECT college_clean AS school, count(*) AS coaches_to_hc FROM moves WHERE next_position = 'Head Coach' GROUP BY 1",
)
def a25(spark, d):
    return careers.exports(careers.movements(positions(spark, d)))


@query(
    "a26_conference_production",
    f"WITH {BEFORE} SELECT conference, position_title_standardized, count(*) AS n FROM app GROUP BY 1, 2",
)
def a26(spark, d):
    return careers.conference_production(positions(spark, d))


RETAIN = """SELECT m.conference, count(*) AS total_moves, count(*) FILTER (m.conference = p.conference) AS same_conference_moves,
      count(*) FILTER (m.conference = p.conference) * 100.0::DOUBLE / count(*) AS loyalty_rate
    FROM moves m JOIN (SELECT coach, college_clean, conference FROM pos WHERE division = 'I') p
      ON m.next_school = p.college_clean AND m.coach = p.coach
    WHERE m.conference IS NOT NULL AND p.conference IS NOT NULL GROUP BY 1"""


@query("a27_conference_retention", f"WITH {MOVES} {RETAIN}", "loyalty_rate")
def a27(spark, d):
    return careers.conference_retention(positions(spark, d))


@query(
    "j16_many_to_many_retention",
    f"WITH {MOVES} SELECT conference, total_moves FROM ({RETAIN})",
)
def j16(spark, d):
    return careers.conference_retention(positions(spark, d)).select("conference", "total_moves")


TIME = (
    POS
    + """, tt AS (SELECT coach, min(start_year) AS first_position_year,
    min(start_year) FILTER (position_title_standardized = 'Head Coach' AND division = 'I') AS first_hc_year FROM pos GROUP BY 1),
th AS (SELECT *, first_hc_year - first_position_year AS years_to_hc FROM tt WHERE first_hc_year - first_position_year >= 0)"""
)


@query("a28_time_to_head", f"WITH {TIME} SELECT * FROM th")
def a28(spark, d):
    return careers.time_to_head(positions(spark, d))


@query(
    "a28_time_to_head_summary",
    f"WITH {TIME} SELECT count(*) AS coaches, avg(years_to_hc) AS mean_years, median(years_to_hc) AS median_years FROM th",
    "mean_years median_years",
)
def a28_summary(spark, d):
    return careers.time_to_head(positions(spark, d)).agg(
        F.count(F.lit(1)).alias("coaches"),
        F.avg("years_to_hc").alias("mean_years"),
        F.median("years_to_hc").alias("median_years"),
    )


@query(
    "a29_finishing_schools",
    f"""WITH {BEFORE} SELECT college_clean, count(DISTINCT coach) AS future_head_coaches,
      avg(coalesce(end_year, {AS_OF}) - start_year) AS avg_years FROM app
    WHERE college_clean IN ({PROGRAM_SQL}) AND {ASSIST} GROUP BY 1""",
    "avg_years",
)
def a29(spark, d):
    return careers.finishing_schools(positions(spark, d), PROGRAMS, AS_OF)


STONES = (
    POS
    + """, st0 AS (SELECT *, lead(college_clean) OVER (PARTITION BY coach ORDER BY start_year NULLS LAST, seq) AS next_school
    FROM pos WHERE division = 'I' AND position_title_standardized = 'Head Coach'),
st AS (SELECT * FROM st0 WHERE next_school IS NOT NULL)"""
)


@query("a30_departures", f"WITH {STONES} SELECT college_clean AS school, count(*) AS hc_departures FROM st GROUP BY 1")
def a30(spark, d):
    moves = careers.stepping_stones(positions(spark, d))
    return moves.groupBy(F.col("college_clean").alias("school")).agg(F.count(F.lit(1)).alias("hc_departures"))


@query("a30_arrivals", f"WITH {STONES} SELECT next_school AS destination, count(*) AS hc_arrivals FROM st GROUP BY 1")
def a30_arrivals(spark, d):
    moves = careers.stepping_stones(positions(spark, d))
    return moves.groupBy(F.col("next_school").alias("destination")).agg(F.count(F.lit(1)).alias("hc_arrivals"))


@query(
    "a31_net_flow",
    f"""WITH {STONES}, o AS (SELECT college_clean AS school, count(*) AS n FROM st GROUP BY 1),
    i AS (SELECT next_school AS school, count(*) AS n FROM st GROUP BY 1)
    SELECT school, coalesce(o.n, 0) AS departures, coalesce(i.n, 0) AS arrivals, coalesce(i.n, 0) - coalesce(o.n, 0) AS net_flow
    FROM o FULL JOIN i USING (school)""",
)
def a31(spark, d):
    return careers.head_flow(careers.stepping_stones(positions(spark, d)))


@query(
    "a32_position_duration",
    f"""WITH {POS} SELECT position_title_standardized, count(*) AS n_positions,
      avg(coalesce(end_year, {AS_OF}) - start_year) AS avg_duration,
      median(coalesce(end_year, {AS_OF}) - start_year) AS median_duration FROM pos WHERE division = 'I' GROUP BY 1""",
    "avg_duration median_duration",
)
def a32(spark, d):
    return careers.position_duration(positions(spark, d), AS_OF)


@query(
    "a33_promotion_rates",
    f"""WITH {MOVES}, p AS (SELECT *, CASE
      WHEN position_title_standardized = 'Staff' AND next_position IN ('Assistant Coach', 'Associate Head Coach', 'Head Coach') THEN 1
      WHEN position_title_standardized = 'Assistant Coach' AND next_position IN ('Associate Head Coach', 'Head Coach') THEN 1
      WHEN position_title_standardized = 'Associate Head Coach' AND next_position = 'Head Coach' THEN 1 ELSE 0 END AS up
      FROM nxt WHERE next_position IS NOT NULL)
    SELECT position_title_standardized, count(*) AS total_moves, CAST(sum(up) AS BIGINT) AS promotions,
      sum(up) * 100.0::DOUBLE / count(*) AS promotion_rate FROM p GROUP BY 1""",
    "promotion_rate",
)
def a33(spark, d):
    return careers.promotion_rates(positions(spark, d))


@query(
    "a12_distinct_summary",
    f"""WITH {POS} SELECT count(*) AS records, count(DISTINCT coach) AS coaches, count(DISTINCT college_clean) AS schools,
      count(*) FILTER (division = 'I') AS division_one FROM pos""",
)
def a12(spark, d):
    return careers.overview(positions(spark, d))


@query(
    "a13_frequency_table",
    f"""WITH {POS} SELECT title, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM pos) AS pct FROM pos GROUP BY 1""",
    "pct",
)
def a13(spark, d):
    return careers.frequency(positions(spark, d), "title")


@query(
    "a14_fragmentation",
    f"""WITH {POS}, t AS (SELECT count(*) AS records, count(DISTINCT title) AS before, count(DISTINCT position_title_standardized) AS after FROM pos)
    SELECT *, before * 100.0::DOUBLE / records AS ratio_pct, (1 - after / before) * 100 AS reduction_pct FROM t""",
    "ratio_pct reduction_pct",
)
def a14(spark, d):
    return careers.fragmentation(positions(spark, d), "title", "position_title_standardized")


@query(
    "a34_missing_audit",
    f"""WITH {POS} SELECT position_title_standardized AS title, count(*) AS records, count(*) FILTER (start_year IS NULL) AS no_start,
      count(*) FILTER (end_year IS NULL) AS no_end, count(*) FILTER (conference IS NULL) AS no_conference FROM pos GROUP BY 1""",
)
def a34(spark, d):
    gaps = [F.count_if(F.col(c).isNull()).alias(n) for c, n in
            (("start_year", "no_start"), ("end_year", "no_end"), ("conference", "no_conference"))]
    return positions(spark, d).groupBy(F.col("position_title_standardized").alias("title")).agg(
        F.count(F.lit(1)).alias("records"), *gaps
    )


@query(
    "a35_lookup_table",
    f"WITH {POS} SELECT title, position_title_standardized, count(*) AS n FROM pos GROUP BY 1, 2",
)
def a35(spark, d):
    return careers.lookup_table(positions(spark, d), "title", "position_title_standardized")


@query(
    "a36_nested_documents",
    f"""WITH {POS} SELECT coach, count(*) AS n, string_agg(college_clean || ':' || position_title_standardized || ':' ||
      coalesce(CAST(start_year AS VARCHAR), 'NA'), '|' ORDER BY seq) AS flat FROM pos GROUP BY 1""",
)
def a36(spark, d):
    nested = careers.nest_positions(positions(spark, d))
    item = lambda p: F.concat_ws(":", p["college"], p["title"], F.coalesce(p["start_year"].cast("string"), F.lit("NA")))
    return nested.select(
        "coach", F.size("positions").alias("n"), F.array_join(F.transform("positions", item), "|").alias("flat")
    )


@query(
    "a37_top_colleges",
    f"WITH {POS} SELECT college, count(*) AS n FROM pos GROUP BY 1 ORDER BY n DESC, college LIMIT 10",
)
def a37(spark, d):
    counts = positions(spark, d).groupBy("college").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "college").limit(10)


@query(
    "w8_case_variants",
    f"""WITH {POS}, t AS (SELECT title, count(*) AS n FROM pos GROUP BY 1)
    SELECT lower(title) AS lower_title, title, n FROM t QUALIFY count(*) OVER (PARTITION BY lower(title)) > 1""",
)
def w8(spark, d):
    """Spellings that differ only by case; few rows remain after counting titles."""
    titles = hold(positions(spark, d).groupBy("title").agg(F.count(F.lit(1)).alias("n")))
    lowered = titles.withColumn("lower_title", F.lower("title"))
    several = lowered.groupBy("lower_title").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > 1)
    return lowered.join(several, "lower_title", "left_semi").select("lower_title", "title", "n")


@query(
    "p19_single_membership",
    f"WITH {POS} SELECT seq, coach, college_clean FROM pos WHERE college_clean IN ({PROGRAM_SQL})",
)
def p19(spark, d):
    return positions(spark, d).where(F.col("college_clean").isin(*PROGRAMS)).select("seq", "coach", "college_clean")


@query(
    "a20_top_with_ties_overall",
    f"""WITH {PROD}, t AS (SELECT college_clean, sum(future_hcs)::BIGINT AS total FROM prod GROUP BY 1)
    SELECT college_clean, total FROM (SELECT *, rank() OVER (ORDER BY total DESC) AS r FROM t) WHERE r <= 10""",
)
def a20_overall(spark, d):
    totals = careers.production_totals(careers.production(positions(spark, d)))
    return ranking.top_with_ties(totals, "total_future_hcs", 10).withColumnRenamed("total_future_hcs", "total")
