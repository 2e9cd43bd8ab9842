"""Readers, writers and the streaming upsert on small files."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from rimsight.operators import changes, plays
from rimsight.plans import q_files
from rimsight.sources import readers, units
from rimsight.streaming import upsert


def test_game_tree_skips_null_files_and_other_types(spark, tmp_path):
    folder = tmp_path / "12-ohio-st" / "2024-25"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text(json.dumps({"ncaa_id": 12, "game_id": "1"}))
    (folder / "2.json").write_text("null")
    (folder / "notes.txt").write_text('{"game_id": "9"}')
    got = readers.read_game_tree(spark, str(tmp_path), plays.GAME_SCHEMA).select("game_id", "slug", "season").collect()
    assert [tuple(r) for r in got] == [("1", "12-ohio-st", "2024-25")]


def test_game_tree_may_be_compressed(spark, tmp_path):
    folder = tmp_path / "slug=12-ohio" / "season=2024-25"
    folder.mkdir(parents=True)
    for name, text in (("1.json.gz", '{"game_id": "1"}\n{"game_id": "2"}\n'), ("2.json.gz", "null"), ("3.txt.gz", '{"game_id": "9"}')):
        (folder / name).write_bytes(gzip.compress(text.encode()))
    (folder / "4.json").write_text('{"game_id": "4"}')
    want = [(n, "12-ohio", "2024-25") for n in ("1", "2", "4")]
    for games in (readers.read_game_tree(spark, str(tmp_path), plays.GAME_SCHEMA), units.game_units(spark, str(tmp_path), plays.GAME_SCHEMA)):
        assert sorted(tuple(r) for r in games.select("game_id", "slug", "season").collect()) == want
    assert {r["unit"] for r in units.read_units(spark, str(tmp_path), ".json").collect()} == {"1", "2", "4"}


def test_game_documents_are_stored_small(spark, tmp_path):
    path = q_files.write_tree(spark, "/root/testdata/sf0.001")
    stored = sum(os.path.getsize(os.path.join(folder, n)) for folder, _, names in os.walk(path) for n in names if n.startswith("part-"))
    plain = spark.read.text(path, recursiveFileLookup=True).agg(F.sum(F.length("value"))).first()[0]
    assert 4 * stored < plain


def test_seasons_skip_missing_and_fail_when_none(spark, tmp_path):
    path = tmp_path / "officials_202425.json"
    path.write_text(json.dumps([{"game_id": 1, "home_fouls": 3, "visitor_fouls": 4, "officials": ["A"]}], indent=1))
    got = readers.read_seasons(spark, [str(path), str(tmp_path / "officials_202324.json")], multi_line=True).collect()
    assert [(r.game_id, r.season, r.total_fouls) for r in got] == [(1, "202425", 7.0)]
    with pytest.raises(readers.MissingInput):
        readers.read_seasons(spark, [str(tmp_path / "none.json")])


def test_csv_with_byte_order_mark_and_account_lines(spark, tmp_path):
    csv = tmp_path / "a.csv"
    csv.write_bytes("﻿name,url\nA,http://x\nB,\n".encode())
    assert [r.name for r in readers.read_csv_rows(spark, str(csv), "name string, url string", "url").collect()] == ["A"]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "lynx.json").write_text('{"id": 1}\n{"id": 2}\n')
    (lines / "teams.json").write_text('{"id": 3}\n')
    (lines / "empty.json").write_text("")
    got = readers.read_account_lines(spark, str(lines), "id int").collect()
    assert sorted((r.id, r.account_name) for r in got) == [(1, "lynx"), (2, "lynx")]


def test_required_columns(spark):
    df = spark.range(1)
    assert readers.require_columns(df, ["id"]) is df
    with pytest.raises(readers.MissingInput, match="team"):
        readers.require_columns(df, ["id", "team"])


def test_streaming_upsert_over_two_runs(spark, tmp_path):
    source, table, marks = (str(tmp_path / n) for n in ("in", "table", "marks"))
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, ord int").coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema("id int, v string, ord int").parquet(source)
    upsert.upsert_stream(stream(), table, ["id"], "ord", marks).awaitTermination()
    spark.createDataFrame([(2, "c", 0), (3, "d", 1)], "id int, v string, ord int").coalesce(1).write.mode("append").parquet(source)
    upsert.upsert_stream(stream(), table, ["id"], "ord", marks).awaitTermination()
    assert {(r.id, r.v) for r in upsert.current(spark, table).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    # a batch whose write never finished is not read
    os.makedirs(f"{table}/manifest/version=99")
    assert upsert.current(spark, table).count() == 3


def test_retried_batch_gives_the_same_table(spark, tmp_path):
    table = str(tmp_path / "t")
    apply = upsert.upsert_batch(table, ["id"], "ord")
    apply(spark.createDataFrame([(1, "a", 1)], "id int, v string, ord int"), 0)
    second = spark.createDataFrame([(1, "b", 1)], "id int, v string, ord int")
    apply(second, 1)
    apply(second, 1)
    assert [(r.id, r.v) for r in upsert.current(spark, table).collect()] == [(1, "b")]


def test_summary_without_changes(spark):
    old = spark.createDataFrame([("t", None, "In")], "team string, name string, status string")
    diff = changes.snapshot_diff(old, old, ["team", "name", "status"])
    assert changes.change_summary(diff, F.col("team"), ["team"], "transfers").first().summary == "no new entries"


def test_unknown_season_is_an_error(spark):
    counts = spark.createDataFrame([(1, "A", 0)], "ncaa_id int, team string, `2024-25` int")
    assert [r.team for r in plays.without_files(counts, "2024-25").collect()] == ["A"]
    with pytest.raises(ValueError):
        plays.without_files(counts, "1999-00")


def test_rating_days_keep_blank_cells(spark, tmp_path):
    for day, head, rows in (
        ("2019-03-22", 7, ["1,Show,NBC,,60,0.5,900", "2,,,,,,"]),
        ("2020-08-06", 17, ["1,Show,,8p,60,0.5,a,,b,,,,,,,,77"]),
    ):
        (tmp_path / f"{day}.csv").write_text("\n".join([",".join(["pos", *(f"c{i}" for i in range(head))]), *(f"{k},{r}" for k, r in enumerate(rows))]) + "\n")
    got = {(r["date"], r["rank"]): r for r in readers.daily_ratings(readers.read_rating_days(spark, str(tmp_path))).collect()}
    first = got["2019-03-22", "1"]
    assert (first["network"], first["time"], first["duration"], first["viewers"], first["viewers_int"]) == ("NBC", "", "60", "900", 900)
    assert (got["2019-03-22", "2"]["program"], got["2019-03-22", "2"]["viewers"]) == ("", "")
    assert (got["2020-08-06", "1"]["network"], got["2020-08-06", "1"]["viewers"]) == ("", "77")


def _files(table):
    return {os.path.relpath(os.path.join(folder, name), table) for folder, _, names in os.walk(f"{table}/data") for name in names if name.endswith(".parquet")}


def test_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    table = str(tmp_path / "t")
    apply = upsert.upsert_batch(table, ["id"], "ord", buckets=16, keep=1)
    schema = "id long, v string, ord int"
    apply(spark.createDataFrame([(i, "a", 1) for i in range(400)], schema), 0)
    first = _files(table)
    assert len(first) == 16
    bucket = spark.range(7, 8).select(upsert.bucket_of(["id"], 16)).first()[0]
    apply(spark.createDataFrame([(7, "b", 1), (7, "c", 2)] + [(7, "hot", 0)] * 50, schema), 1)
    second = _files(table)
    assert {f for f in first - second} == {f for f in first if f"bucket={bucket}/" in f}  # the old copy of the bucket is removed
    assert all(f"version=1/bucket={bucket}/" in f for f in second - first) and len(second) == 16
    rows = {r.id: r.v for r in upsert.current(spark, table).collect()}
    assert len(rows) == 400 and rows[7] == "c" and sorted(os.listdir(f"{table}/manifest")) == ["version=1"]


def test_upsert_survives_a_batch_cut_short_and_new_columns(spark, tmp_path):
    table = str(tmp_path / "t")
    apply = upsert.upsert_batch(table, ["id", "team"], "ord", buckets=4)
    schema = "id long, team string, v string, ord int"
    apply(spark.createDataFrame([(i, None if i % 2 else "x", "a", 1) for i in range(20)], schema), 0)
    # data of batch 1 were written, its manifest was not
    spark.createDataFrame([(1, "junk")], "id long, v string").write.parquet(f"{table}/data/version=1/bucket=0")
    assert {r.v for r in upsert.current(spark, table).collect()} == {"a"}
    apply(spark.createDataFrame([(1, None, "b", 1, True)], schema + ", more boolean"), 1)
    rows = {(r.id, r.team): (r.v, r.more) for r in upsert.current(spark, table).collect()}
    assert len(rows) == 20 and rows[1, None] == ("b", True) and rows[0, "x"] == ("a", None)
    before = _files(table)
    apply(spark.createDataFrame([], schema), 2)
    assert _files(table) <= before and upsert.current(spark, table).count() == 20


def test_upsert_by_order_takes_batches_in_any_order(spark, tmp_path):
    table = str(tmp_path / "t")
    apply = upsert.upsert_batch(table, ["id"], "ord", by_batch=False)
    schema = "id int, v string, ord int"
    apply(spark.createDataFrame([(1, "late", 9), (2, "old", 1)], schema), 0)
    apply(spark.createDataFrame([(1, "early", 3), (2, "new", 5), (3, "a", 1)], schema), 1)
    apply(spark.createDataFrame([(3, "b", 1)], schema), 2)
    assert {(r.id, r.v) for r in upsert.current(spark, table).collect()} == {(1, "late"), (2, "new"), (3, "b")}
