"""Clustering, shape tests and their invariants."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rimsight.operators import archetypes as arch
from rimsight.operators import boxscore as bx


def two_bumps(n, gap, seed):
    rng = np.random.default_rng(seed)
    return np.where(rng.random(n) < 0.4, rng.normal(0, 1, n), rng.normal(gap, 1.5, n))


def fitted_by_hand(x):
    """The same fit in numpy: standardised, started from the split at the mean."""
    z = (x - x.mean()) / x.std()
    n, best = len(z), []
    for equal, params in ((True, 4), (False, 5)):
        r, last = (z > 0).astype(float), -np.inf
        for _ in range(6000):
            w = np.array([(1 - r).sum(), r.sum()])
            mu = np.array([((1 - r) * z).sum(), (r * z).sum()]) / w
            ss = np.array([((1 - r) * (z - mu[0]) ** 2).sum(), (r * (z - mu[1]) ** 2).sum()])
            var = np.maximum(np.full(2, ss.sum() / n) if equal else ss / w, 1e-10)
            logs = np.log(w / n) - 0.5 * np.log(2 * np.pi * var) - (z[:, None] - mu) ** 2 / (2 * var)
            total = np.logaddexp(logs[:, 0], logs[:, 1])
            r, ll = np.exp(logs[:, 1] - total), total.sum()
            if abs(ll - last) < 1e-11 * (1 + abs(ll)):
                break
            last = ll
        best.append(2 * ll - params * np.log(n))
    return max(best) - (-n * (np.log(2 * np.pi) + 1) - 2 * np.log(n))


def test_mixture_gain_equals_the_fit_by_hand(spark):
    pdf = pd.concat(
        [pd.DataFrame({"team": t, "x": two_bumps(n, gap, t)}) for t, gap, n in ((1, 6.0, 400), (2, 0.0, 400), (3, 3.0, 9))], ignore_index=True
    )
    got = {r.team: (r.g, r.g_converged) for r in arch.mixture_gain(spark.createDataFrame(pdf), ["team"], "x", "g").collect()}
    for team, rows in pdf.groupby("team"):
        assert got[team][0] == pytest.approx(fitted_by_hand(rows["x"].to_numpy()), abs=0.05)
        assert got[team][1]
    assert got[1][0] > 50 > got[2][0]


def test_mixture_of_ties_missing_and_flat_values(spark):
    rows = [(1, 1.0), (1, 2.0)] + [(2, 3.0)] * 9 + [(3, 0.0)] * 3 + [(3, 5.0)] * 7 + [(4, float(i)) for i in range(8)] + [(4, None)]
    rows += [(5, float(i)) for i in range(8)] + [(5, float("nan"))]
    got = {r.team: r.g for r in arch.mixture_gain(spark.createDataFrame(rows, "team int, x double"), ["team"], "x", "g").collect()}
    assert {t for t, g in got.items() if g is None} == {1, 2, 4, 5}
    assert np.isfinite(got[3]) and got[3] > 0  # two values, each a component of its own


def test_bimodality_coefficient_by_hand(spark):
    x = np.array([1.0, 2.0, 2.5, 7.0, 8.0, 9.5, 3.0])
    z = (x - x.mean()) / x.std(ddof=1)
    n, g, k = len(x), (z**3).mean(), (z**4).mean() - 3
    want = (g**2 + 1) / (k + 3 * (n - 1) ** 2 / ((n - 2) * (n - 3)))
    df = spark.createDataFrame([(1, float(v)) for v in x] + [(2, 1.0)], "team int, x double")
    got = {r.team: r.b for r in arch.bimodality(df, ["team"], "x", "b").collect()}
    assert got[1] == pytest.approx(want) and got[2] is None


def test_first_component_matches_numpy(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 1))
    data = base * [1.0, 0.8, -0.5] + rng.normal(size=(60, 3)) * 0.3
    rows = [(1, i, *map(float, r), 4.0) for i, r in enumerate(data)]
    df = spark.createDataFrame(rows, "team int, i int, a double, b double, c double, flat double")
    got = arch.first_component(df, ["team"], ["a", "b", "c", "flat"], "pc").orderBy("i").toPandas()["pc"].to_numpy()
    z = (data - data.mean(0)) / data.std(0, ddof=1)
    want = z @ np.linalg.svd(z, full_matrices=False)[2][0]
    assert np.allclose(np.abs(got), np.abs(want))


def test_icc_by_hand_and_too_few_groups(spark):
    rows = [(t, float(v)) for t, vs in {1: [1, 2, 3], 2: [5, 6, 7, 9], 3: [2, 2, 4]}.items() for v in vs]
    df = spark.createDataFrame(rows, "team_id int, x double")
    pdf = pd.DataFrame(rows, columns=["t", "x"])
    sizes, means = pdf.groupby("t").x.count(), pdf.groupby("t").x.mean()
    ssb = (sizes * (means - pdf.x.mean()) ** 2).sum()
    ssw = ((pdf.x - pdf.t.map(means)) ** 2).sum()
    n, k = len(pdf), len(sizes)
    msb, msw = ssb / (k - 1), ssw / (n - k)
    k0 = (n - (sizes**2).sum() / n) / (k - 1)
    assert bx.icc_table(df, ["x"]).first().icc == pytest.approx((msb - msw) / (msb + (k0 - 1) * msw))
    assert bx.icc_table(df.where("team_id < 3"), ["x"]).first().icc is None


def test_kmeans_finds_separate_groups_in_a_fixed_order(spark):
    rng = np.random.default_rng(1)
    rows = [(float(c + rng.normal(0, 0.1)), float(-c)) for c in (0, 10, 20) for _ in range(40)]
    df = spark.createDataFrame(rows, "z_a double, z_b double")
    centers = arch.fit_centers(df, ["a", "b"], k=3, starts=3)
    assert [round(c[0]) for c in centers] == [0, 10, 20]
    placed = arch.nearest(df, centers, ["a", "b"]).groupBy("archetype").count().collect()
    assert {r["archetype"]: r["count"] for r in placed} == {1: 40, 2: 40, 3: 40}


def test_silhouette_prefers_the_true_count(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(c + rng.normal(0, 0.2))) for i, c in enumerate([0, 10, 20, 30] * 30)]
    df = spark.createDataFrame(rows, "game_id int, z_a double")
    sweep = arch.fitted_sweep(df, ["a"], range(3, 6), starts=5).collect()
    assert [r.k for r in sweep if r.is_best] == [4]


def test_silhouettes_by_hand(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(600, 2))
    labels = np.where(np.arange(600) == 5, 9, rng.integers(0, 3, 600))  # one row alone
    rows = [(i, *map(float, p), int(c), 1) for i, (p, c) in enumerate(zip(points, labels))]
    df = spark.createDataFrame(rows, "i int, a double, b double, c int, one int")
    got = {r.name: r.silhouette for r in arch.silhouettes(df, ["a", "b"], ["c", "one"]).collect()}
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    want = []
    for i, own in enumerate(labels):
        if (labels == own).sum() == 1:
            want.append(0.0)
            continue
        a = far[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = min(far[i, labels == c].mean() for c in set(labels.tolist()) - {own})
        want.append((b - a) / max(a, b))
    assert got["c"] == pytest.approx(np.mean(want)) and got["one"] == 0


def test_leading_vector_of_dead_and_single_columns(spark):
    rows = [(1, float(i), 2.0, float(-i)) for i in range(9)] + [(2, 1.0, 1.0, 1.0)] * 3
    df = spark.createDataFrame(rows, "team int, a double, b double, c double")
    got = arch.first_component(df, ["team"], ["a", "b", "c"], "pc").orderBy("team", "a").collect()
    z = (np.arange(9) - 4) / np.arange(9).std(ddof=1)
    assert np.allclose([r.pc for r in got if r.team == 1], z * np.sqrt(2))
    assert [r.pc for r in got if r.team == 2] == [0, 0, 0]


def test_team_metric_invariants(spark):
    rng = np.random.default_rng(2)
    rows = [(t, f"T{t}", int(rng.integers(1, 6)), float(rng.random() + 0.1)) for t in range(6) for _ in range(25)]
    rows += [(9, "One", 2, 0.5)] * 3
    df = spark.createDataFrame(rows, "team_id int, team_short_display_name string, archetype int, closeness_weight double")
    out = arch.team_archetypes(df).toPandas().set_index("team_id")
    shares = out[[f"arch_share_{i}" for i in range(1, 6)]]
    assert np.allclose(shares.sum(axis=1), 1) and np.allclose((shares**2).sum(axis=1), out.hhi)
    assert np.allclose(out.entropy_norm, out.entropy / np.log(5))
    assert np.allclose(out.versatility_score, 0.5 * out.entropy_norm + 0.5 * out.spread_score)
    assert np.isinf(out.loc[9, "dominance_ratio"]) and out.loc[9, "entropy"] == 0 and out.loc[9, "primary_archetype"] == 2


def test_variation_needs_three_values(spark):
    rows = [(1, "A", 1.0, 2.0), (1, "A", 1.0, 4.0), (2, "B", 1.0, 2.0), (2, "B", 2.0, 3.0), (2, "B", 1.0, 5.0), (2, "B", 1.0, None)]
    df = spark.createDataFrame(rows, "team_id int, team_short_display_name string, closeness_weight double, x double")
    got = {r.team_id: r for r in arch.variation_profiles(df, ["x"]).collect()}
    assert got[1].x__wcv is None
    w, x = np.array([1, 2, 1]) / 4, np.array([2.0, 3, 5])
    mean = (w * x).sum()
    assert got[2].x__wcv == pytest.approx(np.sqrt((w * (x - mean) ** 2).sum() / (1 - (w**2).sum())) / mean)


def test_closeness_scale_of_infinity_weighs_alike(spark):
    df = spark.createDataFrame([(5.0,), (50.0,)], "margin double")
    row = [tuple(r) for r in df.select(bx.closeness(F.col("margin"), 10), bx.closeness(F.col("margin"), float("inf"))).collect()]
    assert row == [(1 / 1.5, 1.0), (1 / 6, 1.0)]


def test_kmeans_of_several_k_share_rounds_and_each_start_ends_alone(spark, monkeypatch):
    rng = np.random.default_rng(5)
    spots = np.concatenate([rng.normal(c, 0.3, (400, 2)) for c in ((0, 0), (4, 0), (0, 5), (6, 6))])
    df = spark.createDataFrame(pd.DataFrame(spots, columns=["z_a", "z_b"]))
    rounds = []
    single = {k: arch.fit_centers(df, ["a", "b"], k=k, starts=6) for k in (2, 4)}
    collected = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: rounds.append(1) or collected(self))
    many = arch.fit_many(df, ["a", "b"], [2, 4], starts=6)
    monkeypatch.undo()
    assert len(rounds) < 60
    for k in (2, 4):
        assert np.allclose(many[k], single[k], atol=1e-9)
        own = ((spots[:, None, :] - np.array(many[k])[None]) ** 2).sum(-1).argmin(1)
        assert np.allclose([spots[own == j].mean(0) for j in range(k)], many[k], atol=1e-8)
