"""The listing-planned source and the sink of several tables."""

import os

import pytest
from pyspark.sql import functions as F

from rimsight.sinks import tables
from rimsight.sources import units


def test_units_skip_small_hidden_and_other_files(spark, tmp_path):
    folder = tmp_path / "12-ohio" / "2024-25"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text('{"game_id": "1"}\n\n{"game_id": "2"}')
    (folder / "2.json").write_text("null")
    (folder / "notes.txt").write_text('{"game_id": "9"}')
    (folder / "_3.json").write_text('{"game_id": "3"}')
    os.chmod(folder / "2.json", 0)  # opening it would fail
    rows = units.read_units(spark, str(tmp_path), ".json", 4).orderBy("path", "line").collect()
    assert [(r["unit"], r["line"], r["value"]) for r in rows] == [("1", 0, '{"game_id": "1"}'), ("1", 1, ""), ("1", 2, '{"game_id": "2"}')]
    games = units.game_units(spark, str(tmp_path), "game_id string").collect()
    assert sorted(map(tuple, games)) == [("1", "12-ohio", "2024-25"), ("2", "12-ohio", "2024-25")]
    whole = units.read_units(spark, str(tmp_path), ".json", 4, whole=True).collect()
    assert [(r["unit"], r["line"], r["value"].count("game_id")) for r in whole] == [("1", 0, 2)]
    assert units.read_units(spark, str(tmp_path), ".csv").collect() == []


def test_units_share_tasks_by_size_and_keep_long_lines(spark, tmp_path):
    for k in range(20):
        (tmp_path / f"{k:02d}.txt").write_text("\n".join(f"{k}-{i}" for i in range(10)) + "\n")
    (tmp_path / "long.txt").write_text("é" * 3_000_000 + "\nend")
    rows = units.read_units(spark, str(tmp_path), ".txt", partition_bytes=200)
    assert 3 < rows.rdd.getNumPartitions() < 12
    got = rows.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), F.max("line").alias("top"), F.max(F.length("value")).alias("most")).collect()
    assert {r["unit"]: (r["n"], r["top"]) for r in got}["07"] == (10, 9)
    assert {r["unit"]: (r["n"], r["most"]) for r in got}["long"] == (2, 3_000_000)


def rows(spark, n):
    return spark.range(n).select(
        F.struct(F.col("id").alias("url")).alias("coaches"),
        F.transform(F.sequence(F.lit(1), (F.col("id") % 3 + 1).cast("int")), lambda k: F.struct(F.col("id").alias("coach_url"), k.alias("k"))).alias("positions"),
    )


def test_tables_appear_together(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_tables(rows(spark, 30).repartition(4), path)
    assert tables.read_table(spark, path, "coaches").count() == 30 and tables.read_table(spark, path, "positions").count() == 60
    first = tables.write_tables(rows(spark, 3), path)
    assert tables.read_table(spark, path, "coaches").count() == 3
    assert os.path.isdir(f"{path}/{first}/positions")


def test_a_failing_task_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_tables(rows(spark, 5), path)
    before = sorted(os.listdir(path))
    bad = rows(spark, 400).repartition(4).withColumn("coaches", F.when(F.col("coaches.url") == 399, F.raise_error(F.lit("broken")).cast("struct<url:bigint>")).otherwise(F.col("coaches")))
    with pytest.raises(Exception, match="broken"):
        tables.write_tables(bad, path)
    assert sorted(os.listdir(path)) == before
    assert tables.read_table(spark, path, "coaches").count() == 5 and tables.read_table(spark, path, "positions").count() == 9


def test_null_structs_and_empty_arrays(spark, tmp_path):
    made = spark.createDataFrame([((1,), [(1,), (2,)]), (None, []), ((3,), None)], "a struct<x:long>, b array<struct<y:long>>").coalesce(1)
    tables.write_tables(made, str(tmp_path / "t"))
    assert sorted(r.x for r in tables.read_table(spark, str(tmp_path / "t"), "a").collect()) == [1, 3]
    assert sorted(r.y for r in tables.read_table(spark, str(tmp_path / "t"), "b").collect()) == [1, 2]
