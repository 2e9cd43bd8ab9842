"""Rows are dealt out to tasks by how many there are, not to a fixed number."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rimsight import session
from rimsight.operators import archetypes as arch
from rimsight.operators import boxscore as bx
from rimsight.operators import crew
from rimsight.plans import standins
from rimsight.session import Columns, tasks_for


def test_tasks_follow_the_rows(spark):
    least = spark.sparkContext.defaultParallelism
    assert [tasks_for(spark, n, 10) for n in (0, 1, 10 * least, 10 * least + 1, 10_000)] == [least, least, least, least + 1, 1000]


def test_lines_and_pairs_are_dealt_out_so(spark, monkeypatch, capsys):
    monkeypatch.setattr(standins, "line_tasks", lambda spark, d: 37)
    games = standins.games(spark, "/root/testdata/sf0.001")
    crew.pair_trend(crew.pair_seasons(games, 3, tasks=41)).explain()
    shuffles = [x for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in x]
    assert sorted(x.split("hashpartitioning(")[1].split("#")[0] for x in shuffles if ", 37)" in x) == ["l_orderkey", "o_orderkey"]
    assert len(shuffles) == 3 and sum(", 41)" in x for x in shuffles) == 1


def test_dealt_pairs_count_alike(spark):
    games = spark.createDataFrame([(["a", "b", "c"],), (["b", "a"],), ([],), (None,)], "officials array<string>")
    for tasks in (None, 1, 5):
        got = crew.pair_counts(games, tasks).orderBy(F.col("official_1"), F.col("official_2")).collect()
        assert [tuple(r) for r in got] == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]


def written(folder, known=()):
    found = {os.path.join(at, f) for at, _, names in os.walk(folder) for f in names}
    return {f: os.path.getsize(f) for f in found - set(known)}


def own_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_path", lambda spark, label: f"{tmp_path}/{label}-{len(os.listdir(tmp_path))}")
    return tmp_path


def test_what_clustering_holds_is_small_or_removed(spark, monkeypatch, tmp_path):
    """A fit and its sweep leave a few rows of results, not the table they read."""
    kept = own_folder(monkeypatch, tmp_path)
    session.shared_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")  # this session's own
    rng = np.random.default_rng(3)
    table = spark.createDataFrame(pd.DataFrame({"game_id": range(30_000), "z_a": rng.normal(size=30_000), "z_b": rng.normal(size=30_000)}))
    before = written(folder)
    arch.fit_centers(table, ["a", "b"], k=2, starts=2, iterations=3)
    assert written(folder, before) == written(kept) == {}
    assert [r.k for r in arch.fitted_sweep(table, ["a", "b"], range(2, 4), starts=2, iterations=3).orderBy("k").collect()] == [2, 3]
    assert sum(written(folder, before).values()) < 500_000 and written(kept) == {}


def test_columns_are_removed_also_after_an_error(spark, monkeypatch, tmp_path):
    folder = own_folder(monkeypatch, tmp_path)
    with pytest.raises(ValueError, match="inside"), Columns(spark.range(9).repartition(2)) as kept:
        assert sorted(r.id for r in kept.collect()) == list(range(9)) and written(folder)
        raise ValueError("inside")
    with pytest.raises(Exception, match="broken"):
        Columns(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise("").alias("x")))
    assert written(folder) == {}


def test_box_scores_deal_lines_out_once(spark, tmp_path, capsys):
    line = "l_orderkey long, l_linenumber int, l_suppkey long, l_extendedprice double, l_quantity double, l_tax double, l_discount double, l_returnflag string, l_linestatus string"
    rows = [(o, n, (o or 0) + n, 1000.0 * n, 2.0, 0.1, 0.05, "RAN"[n % 3], "OF"[n % 2]) for o in (1, 2, 3, None) for n in (1, 2, 3, 3)]
    spark.createDataFrame(rows, line).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k % 4) for k in range(9)], "s_suppkey long, s_nationkey int").selectExpr("*", "'s' AS s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(k, f"N{k}") for k in range(25)], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    games = bx.with_opponent(standins.team_box(spark, str(tmp_path)))
    games.explain()
    shuffles = [x.split("hashpartitioning(")[1] for x in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning(" in x]
    assert shuffles and all(x.startswith("l_orderkey#") for x in shuffles)
    assert sorted((r.game_id, r.team_id, r.team_id_opp, r.assists) for r in games.collect()) == [
        (1, 2, 3, 3.0), (1, 3, 2, 1.0), (2, 0, 3, 1.0), (2, 3, 0, 3.0), (3, 0, 1, 3.0), (3, 1, 0, 1.0)]
