"""Box scores, residuals, styles of winning."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.operators import archetypes as arch
from rimsight.operators import boxscore as bx
from rimsight.operators import ranking
from rimsight.operators.keyed import first_per_key
from rimsight.plans.registry import query
from rimsight.plans.standins import BOX, team_box
from rimsight.session import Columns, hold

FEATS = (
    BOX.replace("box AS (", "box AS MATERIALIZED (")
    + """,
opp AS (SELECT b.*, o.team_id AS team_id_opp, o.team_score AS opp_score, o.field_goals_made AS opp_fgm,
    o.field_goals_attempted AS opp_fga, o.three_point_field_goals_made AS opp_3pm,
    o.three_point_field_goals_attempted AS opp_3pa, o.free_throws_made AS opp_ftm, o.free_throws_attempted AS opp_fta,
    o.offensive_rebounds AS opp_orb, o.defensive_rebounds AS opp_drb, o.turnovers AS opp_to
  FROM box b JOIN box o ON b.game_id = o.game_id AND b.team_id <> o.team_id),
feats AS MATERIALIZED (SELECT *,
    (field_goals_made + 0.5 * three_point_field_goals_made) / field_goals_attempted AS efg_pct,
    turnovers / (field_goals_attempted + 0.44 * free_throws_attempted + turnovers) AS tov_pct,
    offensive_rebounds / (offensive_rebounds + opp_drb) AS orb_pct,
    free_throws_made / field_goals_attempted AS ft_rate,
    three_point_field_goals_attempted / field_goals_attempted AS three_par,
    (opp_fgm + 0.5 * opp_3pm) / opp_fga AS opp_efg_pct,
    opp_to / (opp_fga + 0.44 * opp_fta + opp_to) AS opp_tov_pct,
    defensive_rebounds / (defensive_rebounds + opp_orb) AS drb_pct,
    opp_ftm / opp_fga AS opp_ft_rate,
    try_cast(points_in_paint AS DOUBLE) / team_score AS paint_share,
    try_cast(fast_break_points AS DOUBLE) / team_score AS fastbreak_share,
    assists / field_goals_made AS ast_rate,
    free_throws_attempted / field_goals_attempted AS ft_attempt_rate,
    CASE WHEN free_throws_attempted > 0 THEN free_throws_made / free_throws_attempted END AS ft_accuracy
  FROM opp WHERE field_goals_attempted > 0 AND opp_fga > 0)
"""
)
AVGS = (
    FEATS
    + ", avgs AS (SELECT team_id, "
    + ", ".join(f"avg({f}) AS avg_{f}" for f in bx.FEATURES)
    + ", avg(opp_3pa / opp_fga) AS avg_opp_three_par, count(*) AS n_games FROM feats GROUP BY 1)"
)
WINS = (
    AVGS
    + """, wins AS MATERIALIZED (SELECT f.*, team_score - opp_score AS margin,
    1 / (1 + (team_score - opp_score) / 10) AS closeness_weight,
    efg_pct - o.avg_opp_efg_pct AS efg_pct_resid, tov_pct - o.avg_opp_tov_pct AS tov_pct_resid,
    orb_pct - (1 - o.avg_drb_pct) AS orb_pct_resid, ft_rate - o.avg_opp_ft_rate AS ft_rate_resid,
    three_par - o.avg_opp_three_par AS three_par_resid, opp_efg_pct - o.avg_efg_pct AS opp_efg_pct_resid,
    opp_tov_pct - o.avg_tov_pct AS opp_tov_pct_resid, drb_pct - w.avg_drb_pct AS drb_pct_resid,
    opp_ft_rate - o.avg_ft_rate AS opp_ft_rate_resid
  FROM feats f LEFT JOIN avgs o ON f.team_id_opp = o.team_id LEFT JOIN avgs w ON f.team_id = w.team_id
  WHERE team_winner)"""
)
ELIG = (
    WINS
    + """, team_wins AS (SELECT team_id, team_short_display_name, count(*) AS n_wins FROM wins GROUP BY 1, 2 HAVING count(*) >= 20),
elig AS MATERIALIZED (SELECT * FROM wins WHERE team_id IN (SELECT team_id FROM team_wins))"""
)


def icc_sql(features, suffix=""):
    listed = ", ".join(features)
    return f""", long{suffix} AS (SELECT team_id, feature, x FROM (SELECT team_id, {listed} FROM elig) UNPIVOT (x FOR feature IN ({listed}))),
grp{suffix} AS (SELECT feature, team_id, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM long{suffix} GROUP BY 1, 2),
gm{suffix} AS (SELECT feature, sum(n * m) / sum(n) AS g FROM grp{suffix} GROUP BY 1),
ms{suffix} AS (SELECT feature, count(*) AS k, sum(n) AS nn, sum(n * pow(m - g, 2)) / (count(*) - 1) AS msb,
    sum(ss) / (sum(n) - count(*)) AS msw, (sum(n) - sum(n * n) / sum(n)) / (count(*) - 1) AS k0
  FROM grp{suffix} JOIN gm{suffix} USING (feature) GROUP BY 1),
icc{suffix} AS MATERIALIZED (SELECT feature, greatest(0, (msb - msw) / (msb + (k0 - 1) * msw)) AS icc,
    sqrt(greatest(0, (msb - msw) / (msb + (k0 - 1) * msw))) AS weight FROM ms{suffix})"""


def scaled_sql(features, suffix="", weighted=True):
    zs = ", ".join(
        f"(({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER ())"
        + (f" * greatest(0.1, (SELECT weight FROM icc{suffix} WHERE feature = '{f}'))" if weighted else "")
        + f" AS z_{f}"
        for f in features
    )
    return f", zed{suffix} AS MATERIALIZED (SELECT *, {zs} FROM elig)"


# fixed centers in the scaled space, so every step after clustering has an exact check
CENTERS = [
    [0.5, 0.0, 0.0, 0.0, 0.1, 0.0, 0.0, 0.0, 0.0],
    [0.0, -0.5, 0.0, 0.1, 0.0, 0.0, 0.0, 0.0, 0.0],
    [0.0, 0.0, 0.5, 0.0, 0.0, 0.0, 0.0, 0.3, 0.0],
    [0.0, 0.0, 0.0, -0.3, 0.5, 0.0, 0.0, 0.0, 0.2],
    [0.0, 0.0, 0.0, 0.0, 0.0, -0.5, 0.5, 0.0, 0.0],
]


def assigned_sql(features, suffix=""):
    lists = ", ".join(
        "(" + " + ".join(f"pow(z_{f} - ({x}), 2)" for f, x in zip(features, c)) + ")" for c in CENTERS
    )
    return f""", assigned{suffix} AS MATERIALIZED (SELECT *, list_position(ds, list_min(ds)) AS archetype
    FROM (SELECT *, [{lists}] AS ds FROM zed{suffix}))"""


def teams_sql(weight="closeness_weight", suffix="", name="teams"):
    return f""", aw{suffix} AS (SELECT team_id, team_short_display_name, archetype, sum({weight}) AS w, count(*) AS c
    FROM assigned{suffix} GROUP BY 1, 2, 3),
sh{suffix} AS (SELECT *, w / sum(w) OVER (PARTITION BY team_id) AS p FROM aw{suffix}),
{name} AS MATERIALIZED (SELECT *, 1 - hhi_norm AS spread_score, 0.5 * entropy_norm + 0.5 * (1 - hhi_norm) AS versatility_score FROM (
  SELECT *, (hhi - 0.2) / 0.8 AS hhi_norm FROM (
  SELECT team_id, team_short_display_name, CAST(sum(c) AS BIGINT) AS n_wins, -sum(p * ln(p)) AS entropy,
    -sum(p * ln(p)) / ln(5) AS entropy_norm, sum(p * p) AS hhi,
    CASE WHEN count(*) = 1 THEN 'infinity'::DOUBLE ELSE list_sort(list(p), 'DESC')[1] / list_sort(list(p), 'DESC')[2] END AS dominance_ratio,
    arg_min(archetype, row(-c, archetype)) AS primary_archetype, count(*) AS n_archetypes_used,
    {", ".join(f"coalesce(max(p) FILTER (archetype = {i}), 0) AS arch_share_{i}" for i in range(1, 6))}
  FROM sh{suffix} GROUP BY 1, 2)))"""


RES = bx.RESIDUALS
ICC = ELIG + icc_sql(RES)
ZED = ICC + scaled_sql(RES)
ASSIGNED = ZED + assigned_sql(RES)
TEAMS = ASSIGNED + teams_sql()
TEAM_DOUBLES = "entropy entropy_norm hhi dominance_ratio hhi_norm spread_score versatility_score " + " ".join(
    f"arch_share_{i}" for i in range(1, 6)
)


def features(spark, d):
    # held first: both sides of the self-join then read one small table, not the lines twice
    return hold(bx.game_features(bx.with_opponent(hold(team_box(spark, d)))))


def wins(spark, d):
    return bx.win_features(features(spark, d))


def elig(spark, d):
    return hold(bx.eligible(wins(spark, d)))


def assigned(spark, d, names=RES):
    return hold(arch.nearest(arch.scaled(elig(spark, d), names), CENTERS, names))


@query(
    "j1_opponent_join",
    f"""WITH {FEATS} SELECT game_id, team_id, team_id_opp, team_winner, team_score, opp_score, opp_fga, opp_orb FROM opp""",
    "team_score opp_score opp_fga opp_orb",
)
def j1(spark, d):
    return bx.with_opponent(team_box(spark, d)).select(
        "game_id", "team_id", "team_id_opp", "team_winner", "team_score", "opp_score", "opp_fga", "opp_orb"
    )


FEATURE_COLUMNS = bx.FEATURES + ["paint_share", "fastbreak_share", "ast_rate", "ft_attempt_rate", "ft_accuracy"]


@query(
    "m1_game_features",
    f"WITH {FEATS} SELECT game_id, team_id, {', '.join(FEATURE_COLUMNS)} FROM feats",
    " ".join(FEATURE_COLUMNS),
)
def m1(spark, d):
    return bx.game_features(bx.with_opponent(team_box(spark, d))).select("game_id", "team_id", *FEATURE_COLUMNS)


@query(
    "p5_finite_features",
    f"""WITH {FEATS} SELECT game_id, team_id, ft_accuracy, paint_share FROM feats
    WHERE ft_accuracy IS NOT NULL AND paint_share IS NOT NULL""",
    "ft_accuracy paint_share",
)
def p5(spark, d):
    built = bx.game_features(bx.with_opponent(team_box(spark, d)))
    finite = bx._finite("ft_accuracy") & bx._finite("paint_share")
    return built.where(finite).select("game_id", "team_id", "ft_accuracy", "paint_share")


@query(
    "p1_derived_columns",
    f"""WITH {BOX} SELECT game_id, team_id AS id, team_short_display_name AS name,
      field_goals_made / field_goals_attempted AS fg_pct, team_score - 10 AS shifted FROM box""",
    "fg_pct shifted",
)
def p1(spark, d):
    box = team_box(spark, d)
    return (
        box.withColumns(
            {"fg_pct": F.col("field_goals_made") / F.col("field_goals_attempted"), "shifted": F.col("team_score") - 10}
        )
        .withColumnsRenamed({"team_id": "id", "team_short_display_name": "name"})
        .select("game_id", "id", "name", "fg_pct", "shifted")
    )


@query(
    "m2_margin_and_closeness",
    f"""WITH {WINS} SELECT game_id, team_id, margin, closeness_weight, 1 / (1 + margin / 50) AS weight_50,
      1.0::DOUBLE AS weight_inf FROM wins""",
    "margin closeness_weight weight_50 weight_inf",
)
def m2(spark, d):
    won = features(spark, d).where("team_winner").withColumn("margin", F.col("team_score") - F.col("opp_score"))
    m = F.col("margin")
    return won.select(
        "game_id",
        "team_id",
        "margin",
        bx.closeness(m, 10).alias("closeness_weight"),
        bx.closeness(m, 50).alias("weight_50"),
        bx.closeness(m, float("inf")).alias("weight_inf"),
    )


AVG_COLUMNS = [f"avg_{f}" for f in bx.FEATURES] + ["avg_opp_three_par"]


@query("m3_season_averages", f"WITH {AVGS} SELECT * FROM avgs", " ".join(AVG_COLUMNS))
def m3(spark, d):
    return bx.season_averages(bx.game_features(bx.with_opponent(team_box(spark, d))))


@query(
    "j2_season_average_join",
    f"""WITH {AVGS} SELECT game_id, f.team_id, team_id_opp, o.avg_opp_efg_pct AS opp_avg_opp_efg_pct,
      o.avg_drb_pct AS opp_avg_drb_pct, o.avg_efg_pct AS opp_avg_efg_pct, w.avg_drb_pct AS own_avg_drb_pct
    FROM feats f LEFT JOIN avgs o ON f.team_id_opp = o.team_id LEFT JOIN avgs w ON f.team_id = w.team_id""",
    "opp_avg_opp_efg_pct opp_avg_drb_pct opp_avg_efg_pct own_avg_drb_pct",
)
def j2(spark, d):
    f = features(spark, d)
    names = ["opp_avg_opp_efg_pct", "opp_avg_drb_pct", "opp_avg_efg_pct", "own_avg_drb_pct"]
    return bx.with_season_averages(f, bx.season_averages(f)).select("game_id", "team_id", "team_id_opp", *names)


@query(
    "m4_adjusted_residuals",
    f"WITH {WINS} SELECT game_id, team_id, {', '.join(RES)} FROM wins",
    " ".join(RES),
)
def m4(spark, d):
    return wins(spark, d).select("game_id", "team_id", *RES)


@query(
    "m5_residual_summary",
    f"""WITH {WINS}, l AS (SELECT feature, x FROM (SELECT {', '.join(RES)} FROM wins) UNPIVOT (x FOR feature IN ({', '.join(RES)})))
    SELECT feature, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd FROM l GROUP BY 1""",
    "mean sd",
)
def m5(spark, d):
    return bx.residual_summary(wins(spark, d))


@query("m6_eligible_teams", f"WITH {ELIG} SELECT * FROM team_wins")
def m6(spark, d):
    return bx.enough_wins(features(spark, d).where("team_winner"))


@query("m7_icc", f"WITH {ICC} SELECT * FROM icc", "icc weight")
def m7(spark, d):
    return bx.icc_table(elig(spark, d), RES)


@query(
    "m7_icc_embeddings",
    """WITH e AS (SELECT label, unnest(embedding) AS x, 'd' || (generate_subscripts(embedding, 1) - 1) AS feature FROM embeddings),
    grp AS (SELECT feature, label, count(*) AS n, avg(CAST(x AS DOUBLE)) AS m, var_pop(CAST(x AS DOUBLE)) * count(*) AS ss FROM e GROUP BY 1, 2),
    gm AS (SELECT feature, sum(n * m) / sum(n) AS g FROM grp GROUP BY 1),
    ms AS (SELECT feature, sum(n * pow(m - g, 2)) / (count(*) - 1) AS msb, sum(ss) / (sum(n) - count(*)) AS msw,
      (sum(n) - sum(n * n) / sum(n)) / (count(*) - 1) AS k0 FROM grp JOIN gm USING (feature) GROUP BY 1)
    SELECT feature, greatest(0, (msb - msw) / (msb + (k0 - 1) * msw)) AS icc,
      sqrt(greatest(0, (msb - msw) / (msb + (k0 - 1) * msw))) AS weight FROM ms""",
    "icc weight",
)
def m7_embeddings(spark, d):
    table = spark.read.parquet(f"{d}/embeddings.parquet")
    dims = table.agg(F.max(F.size("embedding"))).first()[0]
    wide = table.select("label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"d{i}") for i in range(dims)])
    return bx.icc_table(wide, [f"d{i}" for i in range(dims)], "label")


Z = [f"z_{f}" for f in RES]
# what residuals of wins are made from
BASIC = ["game_id", "team_id", "team_short_display_name", "team_winner", "team_score", "team_id_opp", "opp_score", "opp_3pa", "opp_fga", *bx.FEATURES]


def scaled_wins(spark, d, *keys):
    """Keys and scaled residuals of eligible wins as columns; each table they are made from goes once the next is there."""
    # team rows are files of a known size when wins meet them, so that wins are not dealt out again by team
    with Columns(bx.game_features(bx.with_opponent(team_box(spark, d))).select(*BASIC)) as played, Columns(bx.season_averages(played)) as averages:
        won = bx.win_features(played, averages=averages)
        with Columns(bx.enough_wins(played.where("team_winner"))) as teams:
            wins = Columns(bx.eligible(won, teams=teams).select(*keys, "team_id", *RES))
    with wins as won:
        return Columns(arch.scaled(won).select(*keys, *Z))


@query("m8_weighted_z", f"WITH {ZED} SELECT game_id, team_id, {', '.join(Z)} FROM zed", " ".join(Z))
def m8(spark, d):
    return arch.scaled(elig(spark, d)).select("game_id", "team_id", *Z)


@query("m9_kmeans")
def m9(spark, d):
    """Best of many starts; sizes depend on the random starts, so rows only."""
    z = hold(arch.scaled(elig(spark, d)))
    clustered = arch.nearest(z, arch.fit_centers(z))
    return clustered.groupBy("archetype").agg(F.count(F.lit(1)).alias("n_wins"), F.avg("margin").alias("avg_margin"))


@query(
    "m9_kmeans_invariants",
    f"WITH {ELIG} SELECT count(*) AS n_wins, 5::BIGINT AS n_centers, true AS centers_are_means, true AS cost_at_most_fixed FROM elig",
)
def m9_invariants(spark, d):
    """What any good clustering has: each center the mean of its rows, and no more cost than the fixed centers."""

    def cost(points):
        return F.array_min(F.array(*[sum(F.pow(F.col(c) - F.lit(float(x)), 2) for c, x in zip(Z, p)) for p in points]))

    with scaled_wins(spark, d) as z:
        centers = arch.fit_centers(z)
        ends = F.array(*[F.array(*[F.lit(x) for x in p]) for p in centers])
        own = arch.nearest(z, centers).groupBy("archetype").agg(F.array(*[F.avg(c) for c in Z]).alias("mean"))
        off = F.aggregate(F.zip_with("mean", F.element_at(ends, F.col("archetype")), lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: F.greatest(a, b))
        means = own.agg(F.count(F.lit(1)).alias("n_centers"), (F.max(off) < 1e-6).alias("centers_are_means"))
        costs = z.agg(F.count(F.lit(1)).alias("n_wins"), (F.sum(cost(centers)) <= F.sum(cost(CENTERS))).alias("cost_at_most_fixed"))
        return hold(costs.crossJoin(means).select("n_wins", "n_centers", "centers_are_means", "cost_at_most_fixed"))


@query("m9_kmeans_unweighted")
def m9_unweighted(spark, d):
    z = hold(arch.scaled(elig(spark, d), bx.FEATURES, weighted=False))
    clustered = arch.nearest(z, arch.fit_centers(z, bx.FEATURES), bx.FEATURES)
    return clustered.groupBy("archetype").agg(F.count(F.lit(1)).alias("n_wins"))


@query("m10_silhouette_sweep")
def m10(spark, d):
    with scaled_wins(spark, d, "game_id") as z:
        return arch.fitted_sweep(z, RES, range(3, 9))


# more fixed centers, of which each k takes the first k
SWEEP_CENTERS = CENTERS + [
    [-0.5, 0.0, 0.2, 0.0, 0.0, 0.0, 0.0, -0.3, 0.0],
    [0.0, 0.3, 0.0, 0.0, -0.5, 0.4, 0.0, 0.0, 0.0],
    [0.2, 0.0, -0.4, 0.2, 0.0, 0.0, -0.5, 0.0, 0.0],
]


def _sweep_sql():
    far = ", ".join("(" + " + ".join(f"pow(z_{f} - ({x}), 2)" for f, x in zip(RES, c)) + ")" for c in SWEEP_CENTERS)
    away = " + ".join(f"pow(a.z_{f} - b.z_{f}, 2)" for f in RES)
    return f""", smp AS (SELECT game_id, {', '.join(f'z_{f}' for f in RES)}, [{far}] AS ds FROM zed ORDER BY md5(CAST(game_id AS VARCHAR) || '-42'), game_id LIMIT 2000),
    lab AS MATERIALIZED (SELECT game_id, k, list_position(ds[1:k], list_min(ds[1:k])) AS c FROM smp, (SELECT unnest(range(3, 9)) AS k)),
    dist AS MATERIALIZED (SELECT a.game_id AS i, b.game_id AS j, sqrt({away}) AS d FROM smp a, smp b),
    tot AS (SELECT i, k, c, sum(d) AS t, count(*) AS n FROM dist JOIN lab ON lab.game_id = dist.j GROUP BY 1, 2, 3),
    own AS (SELECT tot.i, tot.k, t / greatest(n - 1, 1) AS a, n FROM tot JOIN lab ON lab.game_id = tot.i AND lab.k = tot.k AND lab.c = tot.c),
    oth AS (SELECT tot.i, tot.k, min(t / n) AS b FROM tot JOIN lab ON lab.game_id = tot.i AND lab.k = tot.k AND lab.c <> tot.c GROUP BY 1, 2),
    sil AS (SELECT k, avg(CASE WHEN own.n > 1 AND b IS NOT NULL THEN (b - a) / greatest(a, b) ELSE 0 END) AS silhouette FROM own LEFT JOIN oth USING (i, k) GROUP BY 1)
    SELECT CAST(k AS BIGINT) AS k, silhouette, k = (SELECT arg_max(k, row(silhouette, -k)) FROM sil) AS is_best FROM sil"""


@query("m10_silhouette_from_centers", f"WITH {ZED}" + _sweep_sql(), "silhouette")
def m10_fixed(spark, d):
    """Euclidean silhouettes of at most 2,000 sampled rows under fixed centers."""
    centers = {k: SWEEP_CENTERS[:k] for k in range(3, 9)}
    return arch.silhouette_sweep(hold(arch.scaled(elig(spark, d))), RES, centers)


@query("m9_nearest_center", f"WITH {ASSIGNED} SELECT game_id, team_id, archetype FROM assigned")
def m9_nearest(spark, d):
    return assigned(spark, d).select("game_id", "team_id", "archetype")


NAMES_SQL = ", ".join(f"('{f}', '{arch.nice_name(f)}', {str(f.removesuffix('_resid') in bx.OFFENSE).lower()})" for f in RES)
MEAN_SQL = ", ".join("('{}', '{}')".format(m, t.replace("'", "''")) for m, t in arch.MEANINGS.items())
DETAIL = (
    ASSIGNED
    + f""", cm AS (SELECT archetype, {', '.join(f'avg(z_{f}) AS {f}' for f in RES)} FROM assigned GROUP BY 1),
cl AS (SELECT archetype, feature, zw FROM cm UNPIVOT (zw FOR feature IN ({', '.join(RES)}))),
fn(feature, feat_nice, off) AS (VALUES {NAMES_SQL}), fm(mk, meaning) AS (VALUES {MEAN_SQL}),
cd AS (SELECT archetype, feature, zw / greatest(0.1, weight) AS z, greatest(0.1, weight) AS icc_wt FROM cl JOIN icc USING (feature)),
detail AS MATERIALIZED (SELECT archetype, feature, z, icc_wt, row_number() OVER (PARTITION BY archetype ORDER BY abs(z) DESC, feature) AS rank,
    CASE WHEN z > 0 THEN 'high' ELSE 'low' END AS direction, meaning, feat_nice,
    CASE WHEN z > 0 THEN '▲' ELSE '▼' END || ' ' || feat_nice || printf(' (z=%+.2f)', z) AS feat_label, off
  FROM cd JOIN fn USING (feature) LEFT JOIN fm ON mk = feature || '_' || CASE WHEN z > 0 THEN 'high' ELSE 'low' END)"""
)
LABEL_SQL = "'S' || archetype || ': ' || CASE WHEN z > 0 THEN 'High ' ELSE 'Low ' END || feat_nice"


def detail(spark, d):
    table = elig(spark, d)
    weights = hold(bx.icc_table(table, RES))
    return hold(arch.center_detail(arch.nearest(arch.scaled(table), CENTERS), weights))


@query("m11_archetype_detail", f"WITH {DETAIL} SELECT * EXCLUDE (off) FROM detail", "z icc_wt")
def m11(spark, d):
    return detail(spark, d)


@query(
    "f43_archetype_labels",
    f"""WITH {DETAIL} SELECT archetype, max({LABEL_SQL}) FILTER (rank = 1) AS arch_label,
      string_agg(feat_label, '  |  ' ORDER BY rank) AS features_str, string_agg(meaning, '; ' ORDER BY rank) AS meaning_str
    FROM detail WHERE rank <= 3 GROUP BY 1""",
)
def f43(spark, d):
    return arch.center_labels(detail(spark, d))


@query(
    "w4_top_feature_per_group",
    f"WITH {DETAIL} SELECT archetype, feature, z FROM detail WHERE rank = 1",
    "z",
)
def w4(spark, d):
    return detail(spark, d).where("rank = 1").select("archetype", "feature", "z")


@query(
    "m27_center_heatmap",
    f"""WITH {DETAIL}, lab AS (SELECT archetype, {LABEL_SQL} AS arch_label FROM detail WHERE rank = 1)
    SELECT archetype, arch_label, feature, z AS z_score, feat_nice AS feature_label, icc_wt,
      CASE WHEN off THEN 'Offense' ELSE 'Defense' END AS feature_group FROM detail JOIN lab USING (archetype)""",
    "z_score icc_wt",
)
def m27(spark, d):
    return arch.center_heatmap(detail(spark, d))


@query("m12_team_archetypes", f"WITH {TEAMS} SELECT * FROM teams", TEAM_DOUBLES)
def m12(spark, d):
    return arch.team_archetypes(assigned(spark, d))


SHARES = [f"arch_share_{i}" for i in range(1, 6)]


@query("m13_archetype_shares", f"WITH {TEAMS} SELECT team_id, {', '.join(SHARES)} FROM teams", " ".join(SHARES))
def m13(spark, d):
    return arch.archetype_shares(assigned(spark, d), F.col("closeness_weight")).select("team_id", *SHARES)


@query(
    "w7_share_of_group_total",
    f"WITH {TEAMS} SELECT team_id, archetype, p AS share FROM sh",
    "share",
)
def w7(spark, d):
    shares = arch.archetype_shares(assigned(spark, d), F.col("closeness_weight"))
    rows = [F.struct(F.lit(i).alias("archetype"), F.col(f"arch_share_{i}").alias("share")) for i in range(1, 6)]
    return shares.select("team_id", F.inline(F.array(*rows))).where("share > 0")


SENS = (
    ASSIGNED
    + """, sw AS (SELECT team_id, team_short_display_name, archetype, s, sum(CASE WHEN s = 0 THEN 1.0::DOUBLE ELSE 1 / (1 + margin / s) END) AS w
    FROM assigned, (VALUES (5), (10), (20), (50), (0)) t(s) GROUP BY 1, 2, 3, 4),
sp AS (SELECT *, w / sum(w) OVER (PARTITION BY team_id, s) AS p FROM sw),
se AS (SELECT team_id, team_short_display_name, s, -sum(p * ln(p)) / ln(5) AS e FROM sp GROUP BY 1, 2, 3),
sens AS MATERIALIZED (SELECT team_id, team_short_display_name, max(e) FILTER (s = 5) AS scale_5, max(e) FILTER (s = 10) AS scale_10,
    max(e) FILTER (s = 20) AS scale_20, max(e) FILTER (s = 50) AS scale_50, max(e) FILTER (s = 0) AS "scale_Inf" FROM se GROUP BY 1, 2)"""
)
SCALE_COLUMNS = [arch.scale_name(s) for s in arch.SCALES]
SCALE_DOUBLES = " ".join(SCALE_COLUMNS)


@query("m14_scale_sensitivity", f"WITH {SENS} SELECT * FROM sens", SCALE_DOUBLES)
def m14(spark, d):
    return arch.scale_sensitivity(assigned(spark, d))


def _avg_rank(column, order=""):
    return f"rank() OVER (ORDER BY {column} {order}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"


@query(
    "m15_scale_rank_correlation",
    f"""WITH {SENS}, r AS (SELECT {', '.join(f'CAST({_avg_rank(c)} AS DOUBLE) AS {c}' for c in SCALE_COLUMNS)} FROM sens)
    """
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS rho FROM r" for a in SCALE_COLUMNS for b in SCALE_COLUMNS
    ),
    "rho",
)
def m15(spark, d):
    return arch.spearman(arch.scale_sensitivity(assigned(spark, d)), "team_id", SCALE_COLUMNS)


MOVE = SENS + f""", mv AS (SELECT *, {_avg_rank('scale_5', 'DESC')} AS rank_tight, {_avg_rank('"scale_Inf"', 'DESC')} AS rank_unweight FROM sens)"""


@query(
    "m16_rank_movement",
    f"WITH {MOVE} SELECT *, abs(rank_tight - rank_unweight) AS rank_change FROM mv",
    SCALE_DOUBLES + " rank_tight rank_unweight rank_change",
)
def m16(spark, d):
    return arch.rank_movement(hold(arch.scale_sensitivity(assigned(spark, d))), "scale_5", "scale_Inf")


CV_FEATURES = [f for fs in arch.VARIATION_GROUPS.values() for f in fs]
CV = (
    ELIG
    + f""", cw AS (SELECT team_id, team_short_display_name, count(*) AS n_wins, {', '.join(
        f"sum(closeness_weight * {f}) / sum(CASE WHEN {f} IS NOT NULL THEN closeness_weight END) AS {f}__wmean" for f in CV_FEATURES
    )} FROM elig GROUP BY 1, 2),
cc AS MATERIALIZED (SELECT cw.team_id, cw.team_short_display_name, any_value(n_wins) AS n_wins, {', '.join(
        f"any_value({f}__wmean) AS {f}__wmean, CASE WHEN count({f}) >= 3 AND abs(any_value({f}__wmean)) >= 1e-10 THEN "
        f"sqrt(greatest(0, (sum(closeness_weight * pow({f} - {f}__wmean, 2)) / sum(CASE WHEN {f} IS NOT NULL THEN closeness_weight END)) "
        f"/ (1 - sum(CASE WHEN {f} IS NOT NULL THEN pow(closeness_weight, 2) END) / pow(sum(CASE WHEN {f} IS NOT NULL THEN closeness_weight END), 2)))) "
        f"/ any_value({f}__wmean) END AS {f}__wcv"
        for f in CV_FEATURES
    )} FROM elig e JOIN cw ON e.team_id = cw.team_id AND e.team_short_display_name = cw.team_short_display_name GROUP BY 1, 2),
comp0 AS (SELECT team_id, team_short_display_name, n_wins, {', '.join(
        f"list_avg([{', '.join(f + '__wcv' for f in fs)}]) AS cv_{g}" for g, fs in arch.VARIATION_GROUPS.items()
    )} FROM cc),
comp AS MATERIALIZED (SELECT *, list_avg([{', '.join('cv_' + g for g in arch.CORE_GROUPS)}]) AS cv_composite_core FROM comp0)"""
)
CV_COLUMNS = [f"{f}__{s}" for f in CV_FEATURES for s in ("wmean", "wcv")]


@query("m17_weighted_variation", f"WITH {CV} SELECT * FROM cc", " ".join(CV_COLUMNS))
def m17(spark, d):
    return arch.variation_profiles(elig(spark, d), CV_FEATURES)


COMP_COLUMNS = [f"cv_{g}" for g in arch.VARIATION_GROUPS] + ["cv_composite_core"]


@query("m18_variation_composites", f"WITH {CV} SELECT * FROM comp", " ".join(COMP_COLUMNS))
def m18(spark, d):
    return arch.variation_composites(arch.variation_profiles(elig(spark, d), CV_FEATURES))


def _join_all(base, *more):
    return base + "".join(m[len(ELIG) :] for m in more)


CONF = """, conf AS (SELECT n_nationkey AS team_id, r_name AS conference_short_name,
    CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'Power 4' WHEN r_name IN ('ASIA') THEN 'High Major' ELSE 'Mid/Low Major' END AS conf_tier
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
COMBINED = (
    TEAMS
    + CV[len(ELIG) :]
    + MOVE[len(ASSIGNED) :]
    + CONF
    + """, combined AS MATERIALIZED (SELECT t.*, cv_composite_core, scale_5, "scale_Inf", abs(rank_tight - rank_unweight) AS rank_change,
    conference_short_name, conf_tier, n_games, t.n_wins / n_games AS win_pct
  FROM teams t JOIN comp USING (team_id) LEFT JOIN mv USING (team_id) LEFT JOIN conf USING (team_id) LEFT JOIN avgs USING (team_id))"""
)
COMBINED_DOUBLES = TEAM_DOUBLES + " cv_composite_core scale_5 scale_Inf rank_change win_pct"


def conference_tiers(spark, d):
    nation = spark.read.parquet(f"{d}/nation.parquet")
    region = spark.read.parquet(f"{d}/region.parquet")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("n_nationkey").alias("team_id"),
        F.col("r_name").alias("conference_short_name"),
        conference_tier(F.col("r_name"), ["AMERICA", "EUROPE"], ["ASIA"]).alias("conf_tier"),
    )


def conference_tier(conference, power, high):
    tier = F.when(conference.isin(*power), "Power 4").when(conference.isin(*high), "High Major")
    return tier.otherwise("Mid/Low Major")


def tier_order(tier):
    return F.when(tier == "Power 4", 1).when(tier == "High Major", 2).otherwise(3)


def combined(spark, d):
    f = features(spark, d)
    table = hold(bx.eligible(bx.win_features(f)))
    placed = hold(arch.nearest(arch.scaled(table), CENTERS))
    teams = arch.team_archetypes(placed)
    comp = arch.variation_composites(arch.variation_profiles(table, CV_FEATURES)).select("team_id", "cv_composite_core")
    moved = arch.rank_movement(hold(arch.scale_sensitivity(placed)), "scale_5", "scale_Inf")
    moved = moved.select("team_id", "scale_5", "scale_Inf", "rank_change")
    joined = teams.join(comp, "team_id").join(moved, "team_id", "left").join(conference_tiers(spark, d), "team_id", "left")
    return hold(bx.win_share(joined, f))


@query("m19_combined_versatility", f"WITH {COMBINED} SELECT * FROM combined", COMBINED_DOUBLES)
def m19(spark, d):
    return combined(spark, d)


PAIRS = [
    ("entropy_norm", "spread_score"),
    ("entropy_norm", "cv_composite_core"),
    ("spread_score", "cv_composite_core"),
    ("versatility_score", "cv_composite_core"),
    ("versatility_score", "win_pct"),
    ("entropy_norm", "win_pct"),
    ("spread_score", "win_pct"),
]


@query(
    "m20_metric_correlations",
    f"WITH {COMBINED} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM combined" for a, b in PAIRS),
    "r",
)
def m20(spark, d):
    return arch.correlations(combined(spark, d), PAIRS)


RAW = TEAMS + icc_sql(bx.FEATURES, "_raw") + scaled_sql(bx.FEATURES, "_raw") + assigned_sql(bx.FEATURES, "_raw") + teams_sql(
    "closeness_weight", "_raw", "teams_raw"
)


@query(
    "m21_raw_against_residual",
    f"""WITH {RAW}, b AS (SELECT t.team_id, t.team_short_display_name, t.entropy_norm AS resid_entropy,
      t.versatility_score AS resid_versatility, r.entropy_norm AS raw_entropy_norm FROM teams t JOIN teams_raw r USING (team_id)),
    k AS (SELECT *, {_avg_rank('resid_entropy', 'DESC')} AS rank_resid, {_avg_rank('raw_entropy_norm', 'DESC')} AS rank_raw FROM b)
    SELECT *, rank_raw - rank_resid AS rank_delta FROM k""",
    "resid_entropy resid_versatility raw_entropy_norm rank_resid rank_raw rank_delta",
)
def m21(spark, d):
    table = elig(spark, d)
    resid = arch.team_archetypes(arch.nearest(arch.scaled(table), CENTERS))
    raw = arch.team_archetypes(arch.nearest(arch.scaled(table, bx.FEATURES), CENTERS, bx.FEATURES))
    return arch.raw_against_residual(resid, raw)


def component_sql(features, suffix, source="elig"):
    """First component of each team: the correlation matrix squared until only the leading vector is left, as in ``leading_vector``."""
    m = len(features)
    cells = ", ".join("1.0::DOUBLE" if a == b else f"coalesce(corr({a}, {b}), 0)" for a in features for b in features)
    square = f"list_transform(range({m * m}), lambda t: list_sum(list_transform(range({m}), lambda k: acc[(t // {m}) * {m} + k + 1] * acc[k * {m} + t % {m} + 1])))"
    trace = " + ".join(f"p[{i * m + i + 1}]" for i in range(m))
    diagonal = ", ".join(f"q[{i * m + i + 1}]" for i in range(m))
    load = ", ".join(f"q[{i * m} + j] / sqrt(q[(j - 1) * {m} + j])" for i in range(m))
    z = " + ".join(f"v[{i + 1}] * ({f} - means[{i + 1}]) / sds[{i + 1}]" for i, f in enumerate(features))
    return f""", cor{suffix} AS (SELECT team_id, [{cells}] AS c, [{', '.join(f'avg({f})' for f in features)}] AS means, [{', '.join(f'stddev_samp({f})' for f in features)}] AS sds
      FROM {source} GROUP BY 1),
    lead{suffix} AS (SELECT team_id, means, sds, [{load}] AS v FROM (SELECT *, list_position([{diagonal}], list_max([{diagonal}])) AS j FROM (
      SELECT team_id, means, sds, list_reduce(list_transform(range(25), lambda i: c), lambda acc, x:
        list_transform([{square}], lambda p: list_transform(p, lambda y: y / ({trace})))[1]) AS q FROM cor{suffix}))),
    pc{suffix} AS MATERIALIZED (SELECT e.game_id, e.team_id, e.team_short_display_name, {z} AS pc FROM {source} e JOIN lead{suffix} l ON e.team_id = l.team_id)"""


def bimodal_sql(suffix):
    return f""", st{suffix} AS (SELECT team_id, (pc - avg(pc) OVER w) / stddev_samp(pc) OVER w AS z FROM pc{suffix} WINDOW w AS (PARTITION BY team_id)),
    mo{suffix} AS (SELECT team_id, count(*) AS n, avg(pow(z, 3)) AS g, avg(pow(z, 4)) - 3 AS k FROM st{suffix} GROUP BY 1),
    bc{suffix} AS (SELECT team_id, (g * g + 1) / (k + 3 * pow(n - 1, 2) / ((n - 2) * (n - 3))) AS bc FROM mo{suffix} WHERE n >= 5)"""


@query("m22_team_components", f"WITH {ELIG}" + component_sql(bx.OFFENSE, "_off") + " SELECT game_id, team_id, pc AS pc_off FROM pc_off", "pc_off")
def m22(spark, d):
    """First components; the loading of largest size is positive."""
    keys = ["team_id", "team_short_display_name"]
    return arch.first_component(elig(spark, d).select("game_id", *keys, *bx.OFFENSE), keys, bx.OFFENSE, "pc_off").select("game_id", "team_id", "pc_off")


@query(
    "m23_bimodality_coefficient",
    f"""WITH {ELIG}, s AS (SELECT team_id, (efg_pct - avg(efg_pct) OVER w) / stddev_samp(efg_pct) OVER w AS z FROM elig WINDOW w AS (PARTITION BY team_id)),
    m AS (SELECT team_id, count(*) AS n, avg(pow(z, 3)) AS g, avg(pow(z, 4)) - 3 AS k FROM s GROUP BY 1)
    SELECT team_id, (g * g + 1) / (k + 3 * pow(n - 1, 2) / ((n - 2) * (n - 3))) AS bc FROM m WHERE n >= 5""",
    "bc",
)
def m23(spark, d):
    return arch.bimodality(elig(spark, d), ["team_id"], "efg_pct", "bc")


@query("m24_mixture_gain")
def m24(spark, d):
    return arch.shape_tests(elig(spark, d))


@query(
    "m24_mixture_checks",
    f"""WITH {ELIG} SELECT team_id, team_short_display_name, side, count(*) AS n, true AS converged, true AS parts_agree, true AS means_agree
    FROM elig, (VALUES ('off'), ('def')) s(side) GROUP BY ALL""",
)
def m24_checks(spark, d):
    """Fits of both components of each team, held against one more step over all rows."""
    keys = ["team_id", "team_short_display_name"]
    return arch.mixture_checks(arch.side_components(elig(spark, d)), [*keys, "side"], "pc")


SHAPE_SQL = (
    TEAMS + component_sql(bx.OFFENSE, "_off") + component_sql(bx.DEFENSE, "_def") + bimodal_sql("_off") + bimodal_sql("_def")
    + """, shape AS (SELECT teams.*, o.bc AS bc_off, f.bc AS bc_def, (o.bc + f.bc) / 2 AS bc_composite FROM teams JOIN bc_off o USING (team_id) JOIN bc_def f USING (team_id)),
    shape_ends AS (SELECT min(bc_composite) AS lo, max(bc_composite) AS hi FROM shape)"""
)


@query(
    "m25_versatility_by_shape",
    f"""WITH {SHAPE_SQL} SELECT team_id, team_short_display_name, n_wins, entropy_norm, bc_composite, (bc_composite - lo) / (hi - lo) AS bc_norm,
      0.5 * entropy_norm + 0.5 * (bc_composite - lo) / (hi - lo) AS versatility_score FROM shape, shape_ends""",
    "entropy_norm bc_composite bc_norm versatility_score",
)
def m25(spark, d):
    table = elig(spark, d)
    teams = arch.team_archetypes(arch.nearest(arch.scaled(table), CENTERS))
    keys = ["team_id", "team_short_display_name"]
    both = arch.first_component(table.select(*keys, *bx.FEATURES), keys, bx.OFFENSE, "pc_off")
    both = hold(arch.first_component(both, keys, bx.DEFENSE, "pc_def").select(*keys, "pc_off", "pc_def"))
    shapes = arch.bimodality(both, keys, "pc_off", "bc_off").join(arch.bimodality(both, keys, "pc_def", "bc_def"), keys)
    shapes = shapes.withColumn("bc_composite", arch.mean_of_known([F.col("bc_off"), F.col("bc_def")]))
    scored = arch.versatility_by_shape(hold(teams), hold(shapes))
    return scored.select("team_id", "team_short_display_name", "n_wins", "entropy_norm", "bc_composite", "bc_norm", "versatility_score")


@query(
    "m25_versatility_by_variation",
    f"""WITH {COMBINED}, e AS (SELECT min(cv_composite_core) AS lo, max(cv_composite_core) AS hi FROM combined)
    SELECT team_id, (cv_composite_core - lo) / (hi - lo) AS bc_norm,
      0.5 * entropy_norm + 0.5 * (cv_composite_core - lo) / (hi - lo) AS versatility_score FROM combined, e""",
    "bc_norm versatility_score",
)
def m25_variation(spark, d):
    """The same min-max score on a composite that SQL can check."""
    table = combined(spark, d)
    shapes = table.select("team_id", F.col("cv_composite_core").alias("bc_composite"))
    return arch.versatility_by_shape(table, shapes).select("team_id", "bc_norm", "versatility_score")


@query("m26_win_share", f"WITH {COMBINED} SELECT team_id, n_wins, n_games, win_pct FROM combined", "win_pct")
def m26(spark, d):
    f = features(spark, d)
    return bx.win_share(bx.enough_wins(f.where("team_winner")), f).select("team_id", "n_wins", "n_games", "win_pct")


@query(
    "f42_conference_tier",
    """SELECT c_custkey, r_name AS conference,
      CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 'Power 4' WHEN r_name IN ('ASIA') THEN 'High Major' ELSE 'Mid/Low Major' END AS tier,
      CASE WHEN r_name IN ('AMERICA', 'EUROPE') THEN 1 WHEN r_name IN ('ASIA') THEN 2 ELSE 3 END::BIGINT AS tier_order
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def f42(spark, d):
    tiers = conference_tiers(spark, d)
    customers = spark.read.parquet(f"{d}/customer.parquet").join(tiers, F.col("c_nationkey") == F.col("team_id"))
    return customers.select(
        "c_custkey",
        F.col("conference_short_name").alias("conference"),
        F.col("conf_tier").alias("tier"),
        tier_order(F.col("conf_tier")).alias("tier_order"),
    )


@query(
    "t4_extremes",
    f"""WITH {COMBINED}, r AS (SELECT team_id, entropy_norm, rank() OVER (ORDER BY entropy_norm DESC) AS hi,
      rank() OVER (ORDER BY entropy_norm) AS lo FROM combined)
    SELECT team_id, CASE WHEN hi <= 8 THEN 'most' ELSE 'least' END AS grp, entropy_norm FROM r WHERE hi <= 8 OR lo <= 8""",
    "entropy_norm",
)
def t4(spark, d):
    teams = hold(arch.team_archetypes(assigned(spark, d)).select("team_id", "entropy_norm"))
    most = ranking.top_with_ties(teams, "entropy_norm", 8).withColumn("grp", F.lit("most")).withColumn("_o", F.lit(1))
    least = ranking.bottom_with_ties(teams, "entropy_norm", 8).withColumn("grp", F.lit("least")).withColumn("_o", F.lit(2))
    return first_per_key(most.unionByName(least), ["team_id"], [F.col("_o")]).select("team_id", "grp", "entropy_norm")


@query(
    "t5_label_set",
    f"""WITH {COMBINED}, r AS (SELECT team_short_display_name AS label, rank() OVER (ORDER BY entropy_norm DESC) AS a,
      rank() OVER (ORDER BY entropy_norm) AS b, rank() OVER (ORDER BY versatility_score DESC) AS c,
      rank() OVER (ORDER BY abs(entropy_norm - spread_score) DESC) AS e FROM combined)
    SELECT DISTINCT label FROM r WHERE a <= 8 OR b <= 5 OR c <= 5 OR e <= 5""",
)
def t5(spark, d):
    teams = hold(
        arch.team_archetypes(assigned(spark, d)).withColumn("gap", F.abs(F.col("entropy_norm") - F.col("spread_score")))
    )
    lists = [
        ranking.top_with_ties(teams, "entropy_norm", 8),
        ranking.bottom_with_ties(teams, "entropy_norm", 5),
        ranking.top_with_ties(teams, "versatility_score", 5),
        ranking.top_with_ties(teams, "gap", 5),
    ]
    labels = [x.select(F.col("team_short_display_name").alias("label")) for x in lists]
    out = labels[0]
    for more in labels[1:]:
        out = out.union(more)
    return out.distinct()


@query(
    "t7_seeded_sample",
    f"""WITH {WINS} SELECT game_id, team_id FROM wins ORDER BY md5(CAST(game_id AS VARCHAR) || '-42'), game_id LIMIT 2000""",
)
def t7(spark, d):
    won = bx.game_features(bx.with_opponent(team_box(spark, d))).where("team_winner")
    return arch.sample_rows(won.select("game_id", "team_id"), "game_id", 2000, 42)


@query(
    "t9_reference_lines",
    f"""WITH {COMBINED}, c AS (SELECT entropy_norm, spread_score FROM combined), q(q) AS (VALUES (0.05::DOUBLE), (0.5::DOUBLE), (0.92::DOUBLE))
    SELECT 'entropy_norm' AS metric, q, CASE q WHEN 0.05 THEN (SELECT quantile_cont(entropy_norm, 0.05) FROM c) WHEN 0.5 THEN (SELECT median(entropy_norm) FROM c)
      ELSE (SELECT quantile_cont(entropy_norm, 0.92) FROM c) END AS value FROM q
    UNION ALL SELECT 'spread_score', q, CASE q WHEN 0.05 THEN (SELECT quantile_cont(spread_score, 0.05) FROM c) WHEN 0.5 THEN (SELECT median(spread_score) FROM c)
      ELSE (SELECT quantile_cont(spread_score, 0.92) FROM c) END FROM q""",
    "q value",
)
def t9(spark, d):
    teams = hold(arch.team_archetypes(assigned(spark, d)))
    parts = [
        ranking.quantiles(teams, m, [0.05, 0.5, 0.92]).select(F.lit(m).alias("metric"), "q", "value") for m in ("entropy_norm", "spread_score")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "t9_price_quantiles",
    """SELECT q, CASE q WHEN 0.05 THEN (SELECT quantile_cont(o_totalprice, 0.05) FROM orders) WHEN 0.5 THEN (SELECT median(o_totalprice) FROM orders)
      ELSE (SELECT quantile_cont(o_totalprice, 0.92) FROM orders) END AS value FROM (VALUES (0.05::DOUBLE), (0.5::DOUBLE), (0.92::DOUBLE)) t(q)""",
    "q value",
)
def t9_prices(spark, d):
    return ranking.quantiles(spark.read.parquet(f"{d}/orders.parquet"), "o_totalprice", [0.05, 0.5, 0.92])
