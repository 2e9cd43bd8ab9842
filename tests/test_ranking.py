"""Ranks and neighbours against pandas, with ties and one hot value or key."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rimsight.operators import keyed, ranking


def hot_values(n=6000):
    rng = np.random.default_rng(7)
    values = np.where(np.arange(n) % 3 == 0, 5.0, np.round(rng.normal(size=n), 2))
    return pd.DataFrame({"id": np.arange(n), "v": values})


def test_average_rank_and_percentile_with_a_third_tied(spark):
    pdf = hot_values()
    df = spark.createDataFrame(pdf).repartition(5)
    for descending in (False, True):
        got = ranking.average_rank(df, "v", "r", descending).toPandas().sort_values("id")
        want = pdf["v"].rank(ascending=not descending)
        assert np.allclose(got["r"].to_numpy(), want.to_numpy())
    got = ranking.percentile(df, "v", "p").toPandas().sort_values("id")
    assert np.allclose(got["p"].to_numpy(), pdf["v"].rank(pct=True).to_numpy() * 100)


def test_average_rank_leaves_missing_unranked(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 1.0)], "id int, v double")
    got = {r.id: r.r for r in ranking.average_rank(df, "v", "r").collect()}
    assert got == {1: 2.0, 2: None, 3: 1.0}


def test_number_rows_is_gapless_in_order(spark):
    pdf = hot_values()
    df = spark.createDataFrame(pdf).repartition(6)
    got = ranking.number_rows(df, [F.desc("v"), F.col("id")], "n").toPandas().sort_values("n")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert got["n"].tolist() == list(range(1, len(pdf) + 1))
    assert got["id"].tolist() == want["id"].tolist()


def test_z_score_flat(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0)], "id int, v double")
    assert [r.z for r in ranking.z_score(df, "v", "z", 0.0).collect()] == [0.0, 0.0]
    assert [r.z for r in ranking.z_score(df, "v", "z").collect()] == [None, None]


def test_next_in_order_matches_a_plain_walk(spark):
    rng = np.random.default_rng(3)
    n = 3000
    rows = [
        (
            "hot" if i % 3 == 0 else f"k{rng.integers(50)}",
            None if rng.random() < 0.1 else int(rng.integers(1990, 2020)),
            i,
            None if rng.random() < 0.1 else f"s{rng.integers(9)}",
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "k string, y int, seq int, s string").repartition(7)
    got = {r.seq: r.nxt for r in ranking.next_in_order(df, "k", "y", [F.col("seq")], {"s": "nxt"}).collect()}
    want = {}
    by_key: dict = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for group in by_key.values():
        group.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        for here, there in zip(group, [*group[1:], None]):
            want[here[2]] = there[3] if there else None
    assert got == want


def test_top_with_ties_keeps_all_tied(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 8, 8, 8, 1])], "id int, v int")
    assert sorted(r.v for r in ranking.top_with_ties(df, "v", 2).collect()) == [8, 8, 8, 9]
    assert sorted(r.v for r in ranking.bottom_with_ties(df, "v", 2).collect()) == [1, 8, 8, 8]


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 5, "z")], "k string, o int, v string")
    assert {(r.k, r.v) for r in keyed.first_per_key(df, ["k"], [F.col("o")]).collect()} == {("a", "x"), ("b", "z")}
    assert {(r.k, r.v) for r in keyed.last_per_key(df, ["k"], [F.col("o")]).collect()} == {("a", None), ("b", "z")}


def test_quantiles_match_numpy_with_ties(spark):
    pdf = hot_values(4001)
    got = {r.q: r.value for r in ranking.quantiles(spark.createDataFrame(pdf), "v", [0.0, 0.05, 0.5, 0.92, 1.0]).collect()}
    assert len(got) == 5 and all(abs(got[q] - np.quantile(pdf["v"], q)) < 1e-9 for q in got)


def test_average_rank_within_columns(spark):
    pdf = pd.concat([hot_values(900).assign(g=g, v=lambda d, g=g: d.v * g) for g in (1, -1)], ignore_index=True)
    got = ranking.average_rank(spark.createDataFrame(pdf), "v", "r", within=["g"]).toPandas().sort_values(["g", "id"])
    want = pdf.assign(r=pdf.groupby("g").v.rank()).sort_values(["g", "id"])
    assert np.allclose(got.r.to_numpy(), want.r.to_numpy())


def test_a_common_value_does_not_gather_its_rows_in_one_task(spark):
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in plain}
    n = 20_000
    df = spark.range(n).select("id", F.when(F.col("id") % 10 == 0, F.col("id") + 2).when(F.col("id") % 10 < 9, F.lit(1)).alias("v")).repartition(8)
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        ranked = ranking.average_rank(df, "v", "r").withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    sizes = {}
    for row in ranked:
        sizes[row["task"]] = sizes.get(row["task"], 0) + (row["v"] == 1)
    assert len(ranked) == n and max(sizes.values()) < n / 4
    ones = sum(row["v"] == 1 for row in ranked)
    rare = sorted(row["v"] for row in ranked if row["v"] not in (None, 1))
    want = {1: (ones + 1) / 2, None: None, **{v: ones + k + 1 for k, v in enumerate(rare)}}
    assert all(row["r"] == want[row["v"]] for row in ranked)
