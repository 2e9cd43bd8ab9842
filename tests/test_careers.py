"""Careers on small histories, including the odd cases."""

import itertools
import random

from rimsight.operators import careers, lookups

SCHEMA = (
    "coach string, seq int, college string, college_clean string, title string, position_title_standardized string, "
    "start_year int, end_year int, division string, conference string"
)


def row(coach, seq, school, title, start, end=None, division="I", conference="C"):
    return (coach, seq, school, school, title, title, start, end, division, conference)


def test_mentor_links_match_the_plain_condition(spark):
    rng = random.Random(5)
    titles = ["Head Coach", "Assistant Coach", "Associate Head Coach", "Staff"]
    rows = []
    for i in range(240):
        start = None if rng.random() < 0.1 else rng.randint(1995, 2010)
        # some tenures end before they start
        end = None if rng.random() < 0.2 else (start or 2000) + rng.randint(-3, 6)
        rows.append(row(f"c{rng.randint(1, 40)}", i, rng.choice(["big", "big", "b", "c"]), rng.choice(titles), start, end, rng.choice(["I", "I", "II"])))
    want = set()
    for a, h in itertools.product(rows, rows):
        if a[3] != h[3] or a[0] == h[0] or a[8] != "I" or h[8] != "I" or h[5] != "Head Coach":
            continue
        if a[5] not in ("Assistant Coach", "Associate Head Coach") or a[6] is None or h[6] is None:
            continue
        if a[6] <= (h[7] if h[7] is not None else 2025) and (a[7] if a[7] is not None else 2025) >= h[6]:
            want.add((a[0], h[0], a[3]))
    got = {tuple(r) for r in careers.mentor_links(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want and want


def test_unknown_head_year_means_before(spark):
    rows = [row("a", 1, "s", "Staff", 2000), row("a", 2, "s", "Head Coach", None), row("b", 3, "s", "Head Coach", 2001), row("b", 4, "s", "Staff", 2001)]
    got = {r.seq: r.before_hc for r in careers.before_head(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}


def test_retention_counts_repeats(spark):
    rows = [row("a", 1, "s", "Staff", 2000, conference="X"), row("a", 2, "t", "Staff", 2001, conference="X"), row("a", 3, "t", "Staff", 2002, conference="Y")]
    got = careers.conference_retention(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.conference, r.total_moves, r.same_conference_moves) for r in got] == [("X", 2, 1)]


def test_net_flow_fills_zero(spark):
    rows = [row("a", 1, "s", "Head Coach", 2000), row("a", 2, "t", "Head Coach", 2004)]
    flow = careers.head_flow(careers.stepping_stones(spark.createDataFrame(rows, SCHEMA)))
    assert {(r.school, r.departures, r.arrivals, r.net_flow) for r in flow.collect()} == {("s", 1, 0, -1), ("t", 0, 1, 1)}


def test_strict_lookup_raises_on_a_miss(spark):
    games = spark.createDataFrame([(1, 2000, 7, 8)], "game int, year int, team_1_id int, team_2_id int")
    history = spark.createDataFrame([(2000, 7, "E", 1, 1), (2000, 7, "W", 9, 2)], "year int, team_id int, region string, seed int, ord int")
    try:
        lookups.strict_sides(games, history, "ord").collect()
    except Exception as error:  # noqa: BLE001
        assert "no history for" in str(error)
    else:
        raise AssertionError("a missing team must raise")
    both = history.unionByName(spark.createDataFrame([(2000, 8, "S", 4, 3)], history.schema))
    got = lookups.strict_sides(games, both, "ord").first()
    assert (got.team_1_region, got.team_1_seed, got.team_2_region) == ("E", 1, "S")


def test_composite_lookup_matches_missing_with_missing(spark):
    rows = spark.createDataFrame([("a", None), ("a", "2"), ("b", None)], "k string, y string")
    table = spark.createDataFrame([("a", None, "old", 1), ("a", None, "new", 2)], "k string, y string, v string, ord int")
    got = {(r.k, r.y): r.v for r in lookups.composite_lookup(rows, table, ["k", "y"], "v", "ord").collect()}
    assert got == {("a", None): "new", ("a", "2"): "", ("b", None): ""}


def test_pathways_only_for_wanted_lengths(spark):
    rows = [row("a", i, "s", t, y) for i, (t, y) in enumerate([("Staff", 2000), ("Assistant Coach", 2001), ("Head Coach", 2005)])]
    got = careers.pathways(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.n_positions, r.pathway, r.n) for r in got] == [(2, "Staff → Assistant Coach", 1)]
