"""Coaching careers: production, ladders, mentors, moves and mobility.

Positions have: coach, college_clean, position_title_standardized, start_year,
end_year, division, conference and seq (input order, the tiebreak).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimsight.operators.ranking import next_in_order, top_with_ties

HEAD = "Head Coach"
ASSISTANTS = ["Assistant Coach", "Associate Head Coach"]
LADDER = ["Staff", "Assistant Coach", "Associate Head Coach", "Head Coach"]


def division_one(positions: DataFrame) -> DataFrame:
    return positions.where(F.col("division") == "I")


def _is_head() -> Column:
    return F.col("position_title_standardized") == HEAD


def _is_assistant() -> Column:
    return F.col("position_title_standardized").isin(*ASSISTANTS)


def head_coaches(positions: DataFrame) -> DataFrame:
    """Everyone who was a division-I head coach."""
    return division_one(positions).where(_is_head()).select("coach").distinct()


def first_head_year(positions: DataFrame) -> DataFrame:
    """Per future division-I head coach, the first year in any head job (null if unknown)."""
    one = _is_head() & (F.col("division") == "I")
    years = positions.groupBy("coach").agg(
        F.min(F.when(_is_head(), F.col("start_year"))).alias("first_hc_year"), F.max(one).alias("_one")
    )
    return years.where("_one").drop("_one")


def before_head(positions: DataFrame) -> DataFrame:
    """Rows of future head coaches with a flag for years before the first head job.

    An unknown first year counts as later than any known start; rows without a
    start year are never before. The aggregate and join replace a whole-coach
    window, so one very long career is split by the skew join.
    """
    flagged = positions.join(first_head_year(positions), "coach")
    before = F.col("first_hc_year").isNull() | (F.col("start_year") < F.col("first_hc_year"))
    return flagged.withColumn("before_hc", F.col("start_year").isNotNull() & before)


def apprentice_rows(positions: DataFrame) -> DataFrame:
    """Division-I rows from before the first head job."""
    return division_one(before_head(positions)).where("before_hc")


def production(positions: DataFrame) -> DataFrame:
    """Different future head coaches by school and title."""
    return apprentice_rows(positions).groupBy("college_clean", "position_title_standardized").agg(
        F.countDistinct("coach").alias("future_hcs")
    )


def production_totals(by_title: DataFrame) -> DataFrame:
    return by_title.groupBy("college_clean").agg(F.sum("future_hcs").alias("total_future_hcs"))


def production_leaders(by_title: DataFrame, n: int = 10) -> DataFrame:
    """Top schools per assistant title, ties kept."""
    return top_with_ties(by_title.where(_is_assistant()), "future_hcs", n, ["position_title_standardized"])


def ladders(positions: DataFrame) -> DataFrame:
    """Per coach: titles held before the first head job in order, how many, and the last; a career is a short list."""
    held = F.array_sort(F.collect_list(F.struct("start_year", "seq", F.col("position_title_standardized").alias("title"))))
    return apprentice_rows(positions).groupBy("coach").agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.max_by("position_title_standardized", F.struct("start_year", "seq")).alias("final_position"),
        F.array_join(F.transform(held, lambda x: x["title"]), " → ").alias("positions_held"),
    )


def frequency(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Counts of each value and their percentage of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(count))
    total = df.agg(F.count(F.lit(1)).alias("_all"))
    return counts.crossJoin(F.broadcast(total)).withColumn("pct", F.col(count) / F.col("_all") * 100).drop("_all")


def pathways(positions: DataFrame, steps: Sequence[int] = (2, 3)) -> DataFrame:
    """Titles joined by arrows for ladders of exactly the given lengths.

    Lengths are counted first, so only lists of that many entries are collected.
    """
    rows = apprentice_rows(positions)
    right = rows.groupBy("coach").agg(F.count(F.lit(1)).alias("n_positions")).where(F.col("n_positions").isin(*steps))
    held = F.array_sort(F.collect_list(F.struct("start_year", "seq", "position_title_standardized")))
    lists = rows.join(right, "coach").groupBy("coach", "n_positions").agg(held.alias("held"))
    path = F.array_join(F.transform("held", lambda s: s["position_title_standardized"]), " → ")
    return lists.groupBy("n_positions", path.alias("pathway")).agg(F.count(F.lit(1)).alias("n"))


def mentor_links(positions: DataFrame, as_of: int = 2025) -> DataFrame:
    """Assistants who overlapped a different head coach at the same school.

    Tenures are spread over their years and joined on (school, year), so one
    school with very many rows is split by year. A pair is kept only at the
    first year both spans share, which makes the spread exact.
    """
    rows = division_one(positions).where(F.col("start_year").isNotNull())
    span = rows.select(
        "coach",
        "college_clean",
        "position_title_standardized",
        "start_year",
        F.coalesce("end_year", F.lit(as_of)).alias("last_year"),
    )
    low, high = F.least("start_year", "last_year"), F.greatest("start_year", "last_year")
    span = span.withColumn("low", low).withColumn("year", F.explode(F.sequence(low, high)))
    juniors = span.where(_is_assistant()).drop("position_title_standardized").distinct()
    heads = (
        span.where(_is_head())
        .select(
            F.col("coach").alias("hc_name"),
            "college_clean",
            "year",
            F.col("start_year").alias("hc_start"),
            F.col("last_year").alias("hc_last"),
            F.col("low").alias("hc_low"),
        )
        .distinct()
    )
    met = juniors.join(heads, ["college_clean", "year"]).where(
        (F.col("coach") != F.col("hc_name"))
        & (F.col("year") == F.greatest("low", "hc_low"))
        & (F.col("start_year") <= F.col("hc_last"))
        & (F.col("last_year") >= F.col("hc_start"))
    )
    return met.select("coach", "hc_name", "college_clean").distinct()


def mentors(links: DataFrame, positions: DataFrame) -> DataFrame:
    """Links per head coach to people who became head coaches."""
    became = links.join(head_coaches(positions), "coach", "left_semi")
    return became.groupBy(F.col("hc_name").alias("mentor")).agg(F.count(F.lit(1)).alias("proteges_who_became_hc"))


def mentor_edges(links: DataFrame, positions: DataFrame, top: int = 15) -> DataFrame:
    leaders = mentors(links, positions).orderBy(F.desc("proteges_who_became_hc"), "mentor").limit(top)
    kept = links.join(leaders, F.col("hc_name") == F.col("mentor"), "left_semi")
    kept = kept.join(head_coaches(positions), "coach", "left_semi")
    return kept.select(F.col("hc_name").alias("from"), F.col("coach").alias("to"), F.col("college_clean").alias("school"))


def with_next(positions: DataFrame, take: dict[str, str]) -> DataFrame:
    """Each row with values of the coach's next row in career order."""
    return next_in_order(positions, "coach", "start_year", [F.col("seq")], take)


def movements(positions: DataFrame) -> DataFrame:
    """Division-I rows whose next row is at another school."""
    take = {"college_clean": "next_school", "position_title_standardized": "next_position", "start_year": "next_start"}
    moved = with_next(division_one(positions), take)
    return moved.where(F.col("next_school").isNotNull() & (F.col("college_clean") != F.col("next_school")))


def routes(moves: DataFrame) -> DataFrame:
    return moves.groupBy(F.col("college_clean").alias("from_school"), F.col("next_school").alias("to_school")).agg(
        F.count(F.lit(1)).alias("coaches")
    )


def exports(moves: DataFrame) -> DataFrame:
    """Moves out of a school into a head job."""
    out = moves.where(F.col("next_position") == HEAD)
    return out.groupBy(F.col("college_clean").alias("school")).agg(F.count(F.lit(1)).alias("coaches_to_hc"))


def conference_production(positions: DataFrame) -> DataFrame:
    """Rows, not people, before the first head job."""
    return apprentice_rows(positions).groupBy("conference", "position_title_standardized").agg(F.count(F.lit(1)).alias("n"))


def conference_retention(positions: DataFrame) -> DataFrame:
    """Moves joined to all of the coach's rows at the next school; repeats count.

    Both sides are counted per key before the join and the counts multiplied,
    which gives the many-to-many totals without the many-to-many rows.
    """
    moves = movements(positions).where(F.col("conference").isNotNull())
    left = moves.groupBy("coach", "next_school", "conference").agg(F.count(F.lit(1)).alias("_m"))
    right = (
        division_one(positions)
        .where(F.col("conference").isNotNull())
        .groupBy("coach", F.col("college_clean").alias("next_school"), F.col("conference").alias("_there"))
        .agg(F.count(F.lit(1)).alias("_r"))
    )
    pairs = left.join(right, ["coach", "next_school"]).withColumn("_n", F.col("_m") * F.col("_r"))
    table = pairs.groupBy("conference").agg(
        F.sum("_n").alias("total_moves"),
        F.sum(F.when(F.col("conference") == F.col("_there"), F.col("_n")).otherwise(0)).alias("same_conference_moves"),
    )
    return table.withColumn("loyalty_rate", F.col("same_conference_moves") / F.col("total_moves") * 100)


def time_to_head(positions: DataFrame) -> DataFrame:
    """Years from the first job to the first division-I head job."""
    one = _is_head() & (F.col("division") == "I")
    years = positions.groupBy("coach").agg(
        F.min("start_year").alias("first_position_year"),
        F.min(F.when(one, F.col("start_year"))).alias("first_hc_year"),
    )
    gap = F.col("first_hc_year") - F.col("first_position_year")
    return years.withColumn("years_to_hc", gap).where(F.col("years_to_hc") >= 0)


def finishing_schools(positions: DataFrame, programs: Sequence[str], as_of: int = 2025) -> DataFrame:
    """Future head coaches among a program's assistants and their mean years there."""
    rows = apprentice_rows(positions).where(F.col("college_clean").isin(*programs) & _is_assistant())
    years = F.coalesce("end_year", F.lit(as_of)) - F.col("start_year")
    return rows.groupBy("college_clean").agg(
        F.countDistinct("coach").alias("future_head_coaches"), F.avg(years).alias("avg_years")
    )


def stepping_stones(positions: DataFrame) -> DataFrame:
    """Head jobs followed by another head job, nothing else considered."""
    heads = division_one(positions).where(_is_head())
    return with_next(heads, {"college_clean": "next_school"}).where(F.col("next_school").isNotNull())


def head_flow(moves: DataFrame) -> DataFrame:
    """Arrivals less departures per school, absent sides as zero."""
    ends = moves.select(
        F.inline(
            F.array(
                F.struct(F.col("college_clean").alias("school"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                F.struct(F.col("next_school").alias("school"), F.lit(0).alias("out"), F.lit(1).alias("into")),
            )
        )
    )
    table = ends.groupBy("school").agg(F.sum("out").alias("departures"), F.sum("into").alias("arrivals"))
    return table.withColumn("net_flow", F.col("arrivals") - F.col("departures"))


def position_duration(positions: DataFrame, as_of: int = 2025) -> DataFrame:
    years = F.coalesce("end_year", F.lit(as_of)) - F.col("start_year")
    rows = division_one(positions).withColumn("years_in_position", years)
    # the exact median counts different values, and years are a short range of whole numbers
    return rows.groupBy("position_title_standardized").agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.avg("years_in_position").alias("avg_duration"),
        F.median("years_in_position").alias("median_duration"),
    )


def promotion_rates(positions: DataFrame) -> DataFrame:
    """Share of moves to a higher rung among rows that have a next title."""
    rows = with_next(division_one(positions), {"position_title_standardized": "next_position"})
    rungs = F.array(*[F.lit(t) for t in LADDER])
    here = F.array_position(rungs, F.col("position_title_standardized"))
    there = F.array_position(rungs, F.col("next_position"))
    promoted = (here > 0) & (there > here)
    table = rows.where(F.col("next_position").isNotNull()).groupBy("position_title_standardized").agg(
        F.count(F.lit(1)).alias("total_moves"), F.sum(promoted.cast("long")).alias("promotions")
    )
    return table.withColumn("promotion_rate", F.col("promotions") / F.col("total_moves") * 100)


def overview(positions: DataFrame) -> DataFrame:
    return positions.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("coach").alias("coaches"),
        F.countDistinct("college_clean").alias("schools"),
        F.count_if(F.col("division") == "I").alias("division_one"),
    )


def fragmentation(df: DataFrame, raw: str, standard: str) -> DataFrame:
    """Different values before and after, per record and as a reduction."""
    table = df.agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct(raw).alias("before"), F.countDistinct(standard).alias("after")
    )
    return table.withColumn("ratio_pct", F.col("before") / F.col("records") * 100).withColumn(
        "reduction_pct", (1 - F.col("after") / F.col("before")) * 100
    )


def lookup_table(df: DataFrame, raw: str, standard: str) -> DataFrame:
    return df.groupBy(raw, standard).agg(F.count(F.lit(1)).alias("n"))


def nest_positions(positions: DataFrame) -> DataFrame:
    """One document per coach: its positions in order, original and standard values."""
    entry = F.struct(
        "seq",
        F.col("college_clean").alias("college"),
        F.col("college").alias("college_original"),
        F.col("position_title_standardized").alias("title"),
        F.col("title").alias("title_original"),
        "start_year",
        "end_year",
    )
    listed = positions.groupBy("coach").agg(F.array_sort(F.collect_list(entry)).alias("positions"))
    return listed.withColumn("positions", F.transform("positions", lambda p: p.dropFields("seq")))


# fixed values: marks of a school entry that is none of the association's
FLAGGED_SCHOOL = "NON_NCAA|AAU|High School|Professional"


def unmapped_titles(rows: DataFrame, raw: str, mapped: str) -> DataFrame:
    """Raw titles that were mapped to nothing or to Other, with their counts."""
    gap = F.col(mapped).isNull() | (F.col(mapped) == "Other")
    return rows.where(gap).groupBy(raw).agg(F.count(F.lit(1)).alias("n"))


def flagged_schools(rows: DataFrame, school: str, pattern: str = FLAGGED_SCHOOL) -> DataFrame:
    """School entries that look like no member school, with their counts."""
    return rows.where(F.col(school).rlike(pattern)).groupBy(school).agg(F.count(F.lit(1)).alias("n"))
