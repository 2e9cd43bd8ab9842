"""Letters that join keys must not lose, rounding of registered results, and pairs without a limit."""

import re
import unicodedata

import duckdb
from pyspark.sql import functions as F

from rimsight.functions.strings import join_key, to_ascii
from rimsight.operators import crew
from rimsight.plans.registry import plain, rounded


def test_every_latin_letter_joins_as_its_base(spark):
    letters = [chr(c) for c in range(0xC0, 0x250) if re.match(r"LATIN (CAPITAL|SMALL) LETTER [A-Z]( WITH (?!SMALL)|$)", unicodedata.name(chr(c)))]
    assert len(letters) > 300
    made = spark.createDataFrame([(x,) for x in letters], "x string")
    for r in made.select("x", join_key("x").alias("k"), to_ascii("x").alias("a")).collect():
        base = re.match(r"LATIN (?:CAPITAL|SMALL) LETTER ([A-Z])", unicodedata.name(r["x"]))[1]
        assert r["k"] == base.lower() and r["a"].upper() == base, (r["x"], r["k"], r["a"])


def test_names_with_capitals_and_double_letters(spark):
    made = spark.createDataFrame([("\u0106osi\u0107",), ("\u0218\u021aEFAN \u00c6BY",), ("Stra\u00dfe \u0132 \u01c5",), (None,), ("Plain 7",)], "x string")
    assert [r[0] for r in made.select(join_key("x")).collect()] == ["cosic", "stefanaeby", "strasseijdz", None, "plain7"]


def test_rounding_agrees_on_natural_ties(spark):
    values = [k / 2**n for n in range(18, 24) for k in (1, 3, 77, 12345)] + [0.1234565, 2.0000005, -0.4453125, 0.0, float("inf")]
    made = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    spread = made.select("i", (F.col("v") * (1 + 2e-16)).alias("v"))
    got = [r["v"] for r in plain(spread).orderBy("i").collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i BIGINT, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    assert got == [v for _, v in con.execute(rounded("SELECT i, v FROM t", ["v"]) + " ORDER BY i").fetchall()]


def test_frequent_pairs_without_a_limit(spark):
    games = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b", "d"])], "id long, officials array<string>")
    try:
        whole = crew.frequent_pairs(games, None)
    except Exception as error:  # the helper needs more columns than a bare crew table has
        raise AssertionError(str(error)) from error
    assert whole.count() == 5 and crew.frequent_pairs(games, 1).count() == 1
