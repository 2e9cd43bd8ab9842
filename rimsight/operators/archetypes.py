"""Styles of winning: clustering, spread over styles, variation, shape tests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimsight.functions.strings import let
from rimsight.operators import ranking
from rimsight.operators.boxscore import DEFENSE, FEATURES, OFFENSE, RESIDUALS, closeness, icc_table, to_long
from rimsight.session import Columns, hold, ship_package

WEIGHT_FLOOR = 0.1
SCALES = [5.0, 10.0, 20.0, 50.0, float("inf")]

# fixed values: feature groups whose variation is reported together
VARIATION_GROUPS = {
    "Shooting": ["efg_pct", "three_par"],
    "Ball_Care": ["tov_pct", "ast_rate"],
    "Rebounding": ["orb_pct", "drb_pct"],
    "Free_Throws": ["ft_attempt_rate", "ft_accuracy"],
    "Scoring_Mix": ["paint_share", "fastbreak_share"],
    "Def_Quality": ["opp_efg_pct", "opp_tov_pct", "opp_ft_rate"],
}
CORE_GROUPS = ["Shooting", "Ball_Care", "Rebounding", "Free_Throws", "Def_Quality"]

# fixed values: display names and plain-language meanings of the features
FEATURE_NAMES = {
    "efg_pct": "eFG%",
    "tov_pct": "TOV%",
    "orb_pct": "ORB%",
    "ft_rate": "FT Rate",
    "three_par": "3PA Rate",
    "opp_efg_pct": "Opp eFG%",
    "opp_tov_pct": "Opp TOV%",
    "drb_pct": "DRB%",
    "opp_ft_rate": "Opp FT Rate",
}
MEANINGS = {
    "efg_pct_resid_high": "shooting better than opponent allows",
    "efg_pct_resid_low": "shooting worse than opponent allows",
    "tov_pct_resid_high": "more turnovers than opponent forces",
    "tov_pct_resid_low": "fewer turnovers than opponent forces",
    "orb_pct_resid_high": "more offensive rebounds than expected",
    "orb_pct_resid_low": "fewer offensive rebounds than expected",
    "ft_rate_resid_high": "more FTs than opponent allows",
    "ft_rate_resid_low": "fewer FTs than opponent allows",
    "three_par_resid_high": "more 3PA than opponent faces",
    "three_par_resid_low": "fewer 3PA than opponent faces",
    "opp_efg_pct_resid_high": "opponent shooting above their average",
    "opp_efg_pct_resid_low": "holding opponent below their average",
    "opp_tov_pct_resid_high": "forcing more turnovers than opponent's norm",
    "opp_tov_pct_resid_low": "opponent taking care of ball vs their norm",
    "drb_pct_resid_high": "rebounding above own average",
    "drb_pct_resid_low": "rebounding below own average",
    "opp_ft_rate_resid_high": "opponent getting more FTs than their norm",
    "opp_ft_rate_resid_low": "opponent getting fewer FTs than their norm",
}


def nice_name(feature: str) -> str:
    base = feature.removesuffix("_resid")
    return ("Δ " if feature != base else "") + FEATURE_NAMES[base]


def scaled(wins: DataFrame, features: Sequence[str] = RESIDUALS, weighted: bool = True) -> DataFrame:
    """Adds ``z_<feature>``: z-scores over all rows, times the floored ICC weight.

    Means, deviations and weights come to one row, so the broadcast is bounded.
    """
    stats = wins.agg(
        *[F.avg(f).alias(f"m_{f}") for f in features], *[F.stddev_samp(f).alias(f"s_{f}") for f in features]
    )
    if weighted:
        weights = icc_table(wins, features).agg(
            *[F.max(F.when(F.col("feature") == f, F.greatest("weight", F.lit(WEIGHT_FLOOR)))).alias(f"w_{f}") for f in features]
        )
        stats = stats.crossJoin(F.broadcast(weights))
    joined = wins.crossJoin(F.broadcast(stats))
    for f in features:
        z = F.try_divide(F.col(f) - F.col(f"m_{f}"), F.col(f"s_{f}"))
        joined = joined.withColumn(f"z_{f}", z * F.col(f"w_{f}") if weighted else z)
    return joined.drop(*[c for c in joined.columns if c[:2] in ("m_", "s_", "w_") and c[2:] in features])


def nearest(scaled_wins: DataFrame, centers: Sequence[Sequence[float]], features: Sequence[str] = RESIDUALS) -> DataFrame:
    """Archetype 1..k of each row: the nearest given center, lowest number on ties."""
    distances = [
        reduce(lambda a, b: a + b, [F.pow(F.col(f"z_{f}") - F.lit(float(x)), 2) for f, x in zip(features, center)])
        for center in centers
    ]
    listed = F.array(*distances)
    return scaled_wins.withColumn("archetype", F.array_position(listed, F.array_min(listed)).cast("int"))


BLOCK_ROWS = 1024  # rows whose distances to all centers a task holds at once


def _blocks(vectors: DataFrame, dims: int) -> DataFrame:
    """Vectors as blocks of at most BLOCK_ROWS rows of doubles, so that a round reads few values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.ascontiguousarray(np.asarray(batch.column(0).flatten(), float).reshape(-1, dims))
            parts = [rows[at : at + BLOCK_ROWS].tobytes() for at in range(0, len(rows), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["block"])

    return vectors.mapInArrow(run, "block binary")


def _round_sums(rows: np.ndarray, centers: Sequence[np.ndarray], total: list[np.ndarray], cost: list[np.ndarray]) -> None:
    """Adds to each start's sums (k x starts x features and size) and cost the rows nearest to each of its centers."""
    wide = np.column_stack([rows, np.ones(len(rows))])
    length = (rows**2).sum(axis=1)[:, None]
    for i, own in enumerate(centers):  # k x starts x features
        best = at = None
        for j, ends in enumerate(own):
            far = rows @ (-2 * ends.T) + (ends**2).sum(axis=1)
            if best is None:
                best, at = far, np.zeros(far.shape, np.int8)
            else:
                np.copyto(at, j, where=far < best)
                np.minimum(best, far, out=best)
        cost[i] += (best + length).sum(axis=0)
        for j in range(len(own)):
            total[i][j] += (at == j).astype(float).T @ wide


def _lloyd(blocks: DataFrame, groups: Sequence[np.ndarray], iterations: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """k-means from many starts at once, for each group (starts x k x features): centers and costs.

    Each round is one job: tasks add up, for every start and center, the rows nearest to it;
    what comes back is groups x starts x k x features numbers, whatever the rows. A start whose
    centers no longer move takes no part in later rounds.
    """
    dims = groups[0].shape[2]

    def sums(centers: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros((*c.shape[:2], dims + 1)) for c in centers]
            cost = [np.zeros(c.shape[1]) for c in centers]
            for batch in batches:
                for block in batch.column(0):
                    _round_sums(np.frombuffer(block.as_buffer(), float).reshape(-1, dims), centers, total, cost)
            flat = np.concatenate([x.ravel() for x in (*total, *cost)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "value"])

        return run

    centers = [np.array(g, float) for g in groups]
    costs = [np.full(len(g), np.inf) for g in groups]
    moving = [np.arange(len(g)) for g in groups]
    for _ in range(iterations):
        live = [i for i, m in enumerate(moving) if len(m)]
        if not live:
            break
        asked = [np.ascontiguousarray(centers[i][moving[i]].transpose(1, 0, 2)) for i in live]
        parts = blocks.mapInArrow(sums(asked), "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
        flat = np.zeros(sum(c.shape[0] * c.shape[1] * (dims + 1) + c.shape[1] for c in asked))
        for row in parts.collect():
            flat[row["at"]] = row["value"]
        ends = np.cumsum([c.shape[0] * c.shape[1] * (dims + 1) for c in asked] + [c.shape[1] for c in asked])
        pieces = np.split(flat, ends[:-1])
        for at, (i, c) in enumerate(zip(live, asked)):
            total, now = pieces[at].reshape(*c.shape[:2], dims + 1), pieces[len(live) + at]
            size = total[:, :, -1:]
            moved = np.where(size > 0, total[:, :, :-1] / np.maximum(size, 1), c).transpose(1, 0, 2)
            own = moving[i]
            still = np.abs(moved - centers[i][own]).reshape(len(own), -1).max(axis=1) < 1e-9
            centers[i][own], costs[i][own] = moved, now
            moving[i] = own[~still]
    return list(zip(centers, costs))


def fit_many(
    scaled_wins: DataFrame, features: Sequence[str], ks: Sequence[int], starts: int = 50, iterations: int = 200, seed: int = 42
) -> dict[int, list[list[float]]]:
    """For each k the k-means centers of the start with the lowest cost, in a fixed order.

    Starts are rows picked by a seeded hash, the same on every run; all starts of every k share a job in each round.
    The rows are read twice, for the starts and for the blocks that all rounds read.
    """
    names = [f"z_{f}" for f in features]
    vectors = scaled_wins.select(F.array(*[F.col(c).cast("double") for c in names]).alias("v"))
    # starts x k rows, a number fixed by the parameters
    picked = [r["v"] for r in vectors.orderBy(F.xxhash64(F.lit(seed), "v"), "v").limit(starts * max(ks)).collect()]
    if not picked:
        raise ValueError("no rows to cluster")
    groups = []
    for k in ks:
        own = picked[: starts * k]
        first = np.array([own[i % len(own)] for i in range(starts * k)], float)
        turned = np.random.default_rng(seed).permutation(len(first))
        groups.append(first[turned].reshape(starts, k, len(names)))
    ship_package(scaled_wins.sparkSession)
    with Columns(_blocks(vectors, len(names))) as blocks:
        fitted = _lloyd(blocks, groups, iterations)
    return {k: sorted([float(x) for x in c] for c in centers[int(cost.argmin())]) for k, (centers, cost) in zip(ks, fitted)}


def fit_centers(
    scaled_wins: DataFrame,
    features: Sequence[str] = RESIDUALS,
    k: int = 5,
    starts: int = 50,
    iterations: int = 200,
    seed: int = 42,
) -> list[list[float]]:
    """k-means centers of the start with the lowest cost, in a fixed order."""
    return fit_many(scaled_wins, features, [k], starts, iterations, seed)[k]


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """min(n, rows) rows in the order of a seeded hash: the same rows on every run."""
    mark = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(mark, key).limit(n)


def silhouettes(sample: DataFrame, columns: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """name and mean silhouette of each labelling of a bounded sample, by Euclidean distance.

    Every task holds the sample (its caller bounds it) and adds up, for a block of rows, the
    distances to the members of each cluster. A row alone in its cluster scores zero, as does
    every row of a labelling with one cluster.
    """
    names = list(labels)
    whole = sample.select(*columns, *names).toArrow()
    points = np.column_stack([whole.column(c).to_numpy() for c in columns]).astype(float)
    groups = [np.unique(whole.column(c).to_numpy(), return_inverse=True)[1] for c in names]
    shared = sample.sparkSession.sparkContext.broadcast((points, groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, groups = shared.value
        for batch in batches:
            at = batch.column(0).to_numpy()
            for start in range(0, len(at), 256):
                own = at[start : start + 256]
                far = np.sqrt(((points[own][:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
                for name, group in zip(names, groups):
                    size = np.bincount(group)
                    total = far @ np.eye(len(size))[group]
                    mine = group[own]
                    rows = np.arange(len(own))
                    a = total[rows, mine] / np.maximum(size[mine] - 1, 1)
                    others = total / size
                    others[rows, mine] = np.inf
                    b = others.min(axis=1)
                    score = np.where((size[mine] > 1) & np.isfinite(b), (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(own)), pa.array(score)], ["name", "score"])

    spark = sample.sparkSession
    blocks = spark.range(len(points)).mapInArrow(run, "name string, score double")
    return blocks.groupBy("name").agg(F.avg("score").alias("silhouette"))


def silhouette_sweep(
    scaled_wins: DataFrame, features: Sequence[str], centers: dict[int, Sequence[Sequence[float]]], key: str = "game_id", rows: int = 2000, seed: int = 42
) -> DataFrame:
    """Mean silhouette of min(``rows``, all) sampled rows for the centers of each k, best k flagged."""
    columns = [f"z_{f}" for f in features]
    named = sample_rows(scaled_wins.select(key, *columns), key, rows, seed)
    for k, points in centers.items():
        named = nearest(named, points, features).withColumnRenamed("archetype", f"k{k}")
    scores = hold(silhouettes(hold(named), columns, [f"k{k}" for k in centers]))
    best = scores.agg(F.max_by("name", F.struct("silhouette", -F.substring("name", 2, 9).cast("int"))).alias("best"))
    k = F.substring("name", 2, 9).cast("int")
    return scores.crossJoin(F.broadcast(best)).select(k.alias("k"), "silhouette", (F.col("name") == F.col("best")).alias("is_best"))


def fitted_sweep(scaled_wins: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 42, starts: int = 10, iterations: int = 100) -> DataFrame:
    """The sweep over centers fitted for each k on all rows, which are read three times."""
    return silhouette_sweep(scaled_wins, features, fit_many(scaled_wins, features, [int(k) for k in ks], starts, iterations, seed), seed=seed)


def center_detail(assigned: DataFrame, weights: DataFrame, features: Sequence[str] = RESIDUALS) -> DataFrame:
    """Mean unweighted z of each archetype and feature, ranked by size, labelled.

    One row per archetype and feature of the list, so the windows are bounded.
    """
    means = assigned.groupBy("archetype").agg(*[F.avg(f"z_{f}").alias(f) for f in features])
    long = to_long(means, ["archetype"], {f: [F.col(f)] for f in features}, ["zw"])
    joined = long.join(F.broadcast(weights.select("feature", "weight")), "feature")
    floored = F.greatest("weight", F.lit(WEIGHT_FLOOR))
    detail = joined.withColumn("z", F.col("zw") / floored).withColumn("icc_wt", floored)
    order = Window.partitionBy("archetype").orderBy(F.desc(F.abs("z")), "feature")
    nice = F.create_map(*[x for f in features for x in (F.lit(f), F.lit(nice_name(f)))])
    meaning = F.create_map(*[x for m, t in MEANINGS.items() for x in (F.lit(m), F.lit(t))])
    up = F.col("z") > 0
    return (
        detail.withColumn("rank", F.row_number().over(order))
        .withColumn("direction", F.when(up, "high").otherwise("low"))
        .withColumn("meaning", F.try_element_at(meaning, F.concat_ws("_", "feature", "direction")))
        .withColumn("feat_nice", nice[F.col("feature")])
        .withColumn("feat_label", signed_label(F.col("feat_nice"), F.col("z")))
        .select("archetype", "feature", "z", "icc_wt", "rank", "direction", "meaning", "feat_nice", "feat_label")
    )


def signed_label(name: Column, z: Column) -> Column:
    arrow = F.when(z > 0, "▲").otherwise("▼")
    return F.concat(arrow, F.lit(" "), name, F.format_string(" (z=%+.2f)", z.cast("double")))


def archetype_label(archetype: Column, nice: Column, z: Column) -> Column:
    return F.concat(F.lit("S"), archetype.cast("string"), F.lit(": "), F.when(z > 0, "High ").otherwise("Low "), nice)


def center_labels(detail: DataFrame) -> DataFrame:
    """Label from the top feature, descriptions from the top three."""
    top = F.col("rank") == 1
    label = archetype_label(F.col("archetype"), F.col("feat_nice"), F.col("z"))
    three = detail.where(F.col("rank") <= 3)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "feat_label", "meaning")))
    return three.groupBy("archetype").agg(
        F.max(F.when(top, label)).alias("arch_label"),
        F.array_join(F.transform(ordered, lambda s: s["feat_label"]), "  |  ").alias("features_str"),
        F.array_join(F.transform(ordered, lambda s: s["meaning"]), "; ").alias("meaning_str"),
    )


def center_heatmap(detail: DataFrame) -> DataFrame:
    offense = F.regexp_replace("feature", "_resid$", "").isin(*OFFENSE)
    labels = detail.where("rank = 1").select(
        "archetype", archetype_label(F.col("archetype"), F.col("feat_nice"), F.col("z")).alias("arch_label")
    )
    return detail.join(F.broadcast(labels), "archetype").select(
        "archetype",
        "arch_label",
        "feature",
        F.col("z").alias("z_score"),
        F.col("feat_nice").alias("feature_label"),
        "icc_wt",
        F.when(offense, "Offense").otherwise("Defense").alias("feature_group"),
    )


def archetype_shares(assigned: DataFrame, weight: Column, k: int = 5) -> DataFrame:
    """Per team: games, summed weight and plain count of each archetype 1..k, one pass."""
    named = assigned.withColumn("_w", weight)
    cells = []
    for i in range(1, k + 1):
        here = F.col("archetype") == i
        cells += [F.sum(F.when(here, F.col("_w")).otherwise(0.0)).alias(f"w{i}"), F.count(F.when(here, 1)).alias(f"c{i}")]
    summed = named.groupBy("team_id", "team_short_display_name").agg(
        F.count(F.lit(1)).alias("n_wins"), F.sum("_w").alias("total_w"), *cells
    )
    return summed.withColumns({f"arch_share_{i}": F.col(f"w{i}") / F.col("total_w") for i in range(1, k + 1)})


def _entropy(shares: Sequence[Column]) -> Column:
    terms = [F.when(p > 0, -p * F.log(p)).otherwise(0.0) for p in shares]
    return reduce(lambda a, b: a + b, terms)


def team_archetypes(assigned: DataFrame, weight: Column | str = "closeness_weight", k: int = 5) -> DataFrame:
    """Entropy, concentration, dominance and shares of each team's wins."""
    weight = F.col(weight) if isinstance(weight, str) else weight
    table = archetype_shares(assigned, weight, k)
    shares = [F.col(f"arch_share_{i}") for i in range(1, k + 1)]
    counts = [F.col(f"c{i}") for i in range(1, k + 1)]
    ordered = F.reverse(F.array_sort(F.array(*shares)))
    hhi = reduce(lambda a, b: a + b, [p * p for p in shares])
    used = reduce(lambda a, b: a + b, [F.when(c > 0, 1).otherwise(0) for c in counts])
    listed = F.array(*counts)
    second = F.element_at(ordered, 2)
    return (
        table.withColumn("entropy", _entropy(shares))
        .withColumn("entropy_norm", F.col("entropy") / float(np.log(k)))
        .withColumn("hhi", hhi)
        .withColumn(
            "dominance_ratio",
            F.when(second < 1e-10, F.lit(float("inf"))).otherwise(F.try_divide(F.element_at(ordered, 1), second)),
        )
        .withColumn("primary_archetype", F.array_position(listed, F.array_max(listed)).cast("int"))
        .withColumn("n_archetypes_used", used)
        .withColumn("hhi_norm", (F.col("hhi") - 1 / k) / (1 - 1 / k))
        .withColumn("spread_score", 1 - F.col("hhi_norm"))
        .withColumn("versatility_score", 0.5 * F.col("entropy_norm") + 0.5 * F.col("spread_score"))
        .drop("total_w", *[f"{p}{i}" for p in "wc" for i in range(1, k + 1)])
    )


def scale_name(scale: float) -> str:
    return "scale_Inf" if scale == float("inf") else f"scale_{scale:g}"


def scale_sensitivity(assigned: DataFrame, scales: Sequence[float] = SCALES, k: int = 5) -> DataFrame:
    """Normalised entropy under each closeness scale, all scales in one aggregate."""
    cells = []
    for s, scale in enumerate(scales):
        weight = closeness(F.col("margin"), scale)
        cells += [
            F.sum(F.when(F.col("archetype") == i, weight).otherwise(0.0)).alias(f"w{s}_{i}") for i in range(1, k + 1)
        ]
    summed = assigned.groupBy("team_id", "team_short_display_name").agg(*cells)
    out = []
    for s, scale in enumerate(scales):
        parts = [F.col(f"w{s}_{i}") for i in range(1, k + 1)]
        total = reduce(lambda a, b: a + b, parts)
        out.append((_entropy([p / total for p in parts]) / float(np.log(k))).alias(scale_name(scale)))
    return summed.select("team_id", "team_short_display_name", *out)


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are known; null without spread.

    The built-in aggregate divides by zero there, which ANSI mode raises on.
    """
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def spearman(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every two columns, long form; all columns ranked in one pass."""
    long = hold(to_long(df, [key], {c: [F.col(c)] for c in columns}, ["value"]))
    ranked = ranking.average_rank(long, "value", "rank", within=["feature"])
    wide = ranked.groupBy(key).agg(*[F.max(F.when(F.col("feature") == c, F.col("rank"))).alias(c) for c in columns])
    return correlations(wide, [(a, b) for a in columns for b in columns]).withColumnRenamed("r", "rho")


def rank_movement(sensitivity: DataFrame, tight: str, loose: str) -> DataFrame:
    ranked = ranking.average_rank(sensitivity, tight, "rank_tight", descending=True)
    ranked = ranking.average_rank(ranked, loose, "rank_unweight", descending=True)
    return ranked.withColumn("rank_change", F.abs(F.col("rank_tight") - F.col("rank_unweight")))


def variation_profiles(wins: DataFrame, features: Sequence[str], weight: str = "closeness_weight") -> DataFrame:
    """Weighted mean and coefficient of variation of each feature per team.

    Null under three values or a mean near zero. The reliability variance is
    taken around a first pass's mean, since raw second moments would cancel.
    """
    keys = ["team_id", "team_short_display_name"]
    w = F.col(weight)
    known = {f: F.when(F.col(f).isNotNull(), w) for f in features}
    means = wins.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_wins"),
        *[F.try_divide(F.sum(w * F.col(f)), F.sum(known[f])).alias(f"{f}__wmean") for f in features],
    )
    centered = wins.select(*keys, weight, *features).join(means.drop("n_wins"), keys)
    second = []
    for f in features:
        second += [
            F.count(f).alias(f"{f}__n"),
            F.sum(known[f]).alias(f"{f}__sw"),
            F.sum(F.pow(known[f], 2)).alias(f"{f}__sw2"),
            F.sum(w * F.pow(F.col(f) - F.col(f"{f}__wmean"), 2)).alias(f"{f}__ss"),
        ]
    spread = centered.groupBy(*keys).agg(*second)
    out = []
    for f in features:
        mean, sw = F.col(f"{f}__wmean"), F.col(f"{f}__sw")
        variance = F.try_divide(F.col(f"{f}__ss") / sw, 1 - F.col(f"{f}__sw2") / (sw * sw))
        cv = F.sqrt(F.greatest(F.lit(0.0), variance)) / mean
        ok = (F.col(f"{f}__n") >= 3) & (F.abs(mean) >= 1e-10)
        out += [mean, F.when(ok, cv).alias(f"{f}__wcv")]
    return means.join(spread, keys).select(*keys, "n_wins", *out)


def mean_of_known(columns: Sequence[Column]) -> Column:
    """Row mean of the non-null columns; null when none is known."""
    known = F.filter(F.array(*columns), lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(known) > 0, total / F.size(known))


def variation_composites(profiles: DataFrame) -> DataFrame:
    groups = {f"cv_{g}": mean_of_known([F.col(f"{f}__wcv") for f in fs]) for g, fs in VARIATION_GROUPS.items()}
    kept = profiles.select("team_id", "team_short_display_name", "n_wins", *[c.alias(n) for n, c in groups.items()])
    return kept.withColumn("cv_composite_core", mean_of_known([F.col(f"cv_{g}") for g in CORE_GROUPS]))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of each pair over rows where both are known."""
    wide = df.agg(*[correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))


def raw_against_residual(residual_teams: DataFrame, raw_teams: DataFrame) -> DataFrame:
    """Ranks of normalised entropy under both clusterings and their difference."""
    keys = ["team_id", "team_short_display_name"]
    left = residual_teams.select(
        *keys, F.col("entropy_norm").alias("resid_entropy"), F.col("versatility_score").alias("resid_versatility")
    )
    right = raw_teams.select(*keys, F.col("entropy_norm").alias("raw_entropy_norm"))
    both = hold(left.join(right, keys))
    ranked = ranking.average_rank(both, "resid_entropy", "rank_resid", descending=True)
    ranked = ranking.average_rank(ranked, "raw_entropy_norm", "rank_raw", descending=True)
    return ranked.withColumn("rank_delta", F.col("rank_raw") - F.col("rank_resid"))


def bimodality(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Bimodality coefficient per group from Spark's population moments."""
    m = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.stddev_samp(value).alias("s"), F.skewness(value).alias("g"), F.kurtosis(value).alias("k")
    )
    n = F.col("n").cast("double")
    shrink = (n - 1) / n
    g = F.col("g") * F.pow(shrink, 1.5)
    k = (F.col("k") + 3) * shrink * shrink - 3
    denominator = k + F.try_divide(3 * F.pow(n - 1, 2), (n - 2) * (n - 3))
    ok = (n >= 5) & (F.col("s") >= 1e-10) & (F.abs(denominator) >= 1e-10)
    return m.select(*keys, F.when(ok, F.try_divide(g * g + 1, denominator)).alias(out))


SQUARINGS = 24


def leading_vector(matrix: Column, m: int) -> Column:
    """Unit eigenvector of the largest eigenvalue of a flat m x m correlation matrix; zeros for a zero matrix.

    The matrix is squared over and over, each time divided by its trace, which leaves the
    projection onto the vector unless two eigenvalues agree to about seven digits. The sign
    is such that the loading of largest size is positive.
    """
    places, row = F.sequence(F.lit(0), F.lit(m * m - 1)), F.sequence(F.lit(0), F.lit(m - 1))

    def trace(x: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.get(x, F.lit(i * m + i)) for i in range(m)])

    def squared(x: Column) -> Column:
        def cell(t: Column) -> Column:
            i, j = F.floor(t / m).cast("int"), t % m
            return F.aggregate(row, F.lit(0.0), lambda total, k: total + F.get(x, i * m + k) * F.get(x, k * m + j))

        return let(F.transform(places, cell), lambda p: let(trace(p), lambda t: F.transform(p, lambda v: F.when(t > 0, v / t).otherwise(0.0))))

    def vector(x: Column) -> Column:
        diagonal = F.array(*[F.get(x, F.lit(i * m + i)) for i in range(m)])
        at = let(diagonal, lambda d: F.array_position(d, F.array_max(d)).cast("int") - 1)
        return let(at, lambda j: let(F.sqrt(F.get(x, j * m + j)), lambda size: F.transform(row, lambda i: F.when(size > 0, F.get(x, i * m + j) / size).otherwise(0.0))))

    return let(F.aggregate(F.sequence(F.lit(1), F.lit(SQUARINGS)), matrix, lambda x, _: squared(x)), vector)


def first_component(df: DataFrame, keys: Sequence[str], features: Sequence[str], out: str) -> DataFrame:
    """First principal component of each group's standardised features.

    Spark aggregates means, deviations and correlations of every group, and the leading
    vector of each correlation matrix is a column expression, whatever the group's size.
    Columns without variance get no loading.
    """
    m = len(features)
    live = [F.stddev_samp(f) > 1e-10 for f in features]

    def cell(i: int, j: int) -> Column:
        value = F.lit(1.0) if i == j else correlation(features[min(i, j)], features[max(i, j)])
        return F.coalesce(F.when(live[i] & live[j], F.nanvl(value, F.lit(0.0))), F.lit(0.0))

    stats = df.groupBy(*keys).agg(
        F.array(*[F.avg(f) for f in features]).alias("_mean"),
        F.array(*[F.stddev_samp(f) for f in features]).alias("_sd"),
        F.array(*[cell(i, j) for i in range(m) for j in range(m)]).alias("_corr"),
    )
    solved = hold(stats.select(*keys, "_mean", "_sd", leading_vector(F.col("_corr"), m).alias("_load")))
    joined = df.join(solved, list(keys))
    terms = [
        F.coalesce(F.col("_load")[i] * F.try_divide(F.col(f) - F.col("_mean")[i], F.col("_sd")[i]), F.lit(0.0))
        for i, f in enumerate(features)
    ]
    return joined.withColumn(out, reduce(lambda a, b: a + b, terms)).drop("_mean", "_sd", "_load")


EM_STEPS = 300
EM_TOLERANCE = 1e-10
CELLS = 1024  # of a group's range, in which its values are counted for the fit


def fit_mixture(count: np.ndarray, first: np.ndarray, second: np.ndarray, equal: bool) -> tuple[np.ndarray, bool]:
    """Means, variances and parts of two normals (``equal`` variance or not), and whether the fit converged.

    Values come as cells: their number, sum and sum of squares. Shares are taken at a cell's
    mean, moments from its sums. Started from the split at zero. Each round takes two plain
    steps and extrapolates them (squared extrapolation), going back to the plain ones where
    that lowers the likelihood; it stops when likelihood and parameters do, or when a
    component runs empty.
    """
    n, center = count.sum(), first / count

    def moments(share: np.ndarray) -> np.ndarray:
        weight = np.array([(count * (1 - share)).sum(), (count * share).sum()])
        safe = np.maximum(weight, 1e-300)
        mean = np.array([(first * (1 - share)).sum(), (first * share).sum()]) / safe
        spread = np.array([(second * (1 - share)).sum(), (second * share).sum()]) - weight * mean**2
        var = np.maximum(np.full(2, spread.sum() / n) if equal else spread / safe, 1e-10)
        return np.concatenate([mean, var, weight / n])

    def step(params: np.ndarray) -> tuple[np.ndarray, float]:
        """Parameters after a plain step, likelihood before it."""
        mean, var, part = params[:2, None], params[2:4, None], np.maximum(params[4:, None], 1e-300)
        logs = np.log(part) - 0.5 * np.log(2 * np.pi * var) - (center - mean) ** 2 / (2 * var)
        density = np.logaddexp(logs[0], logs[1])
        return moments(np.exp(logs[1] - density)), float((count * density).sum())

    def free(p: np.ndarray) -> np.ndarray:
        return np.concatenate([p[:2], np.log(p[2:4]), [np.log(p[5] / p[4])]])

    def bound(t: np.ndarray) -> np.ndarray:
        part = 1 / (1 + np.exp(-np.clip(t[4], -30, 30)))
        return np.concatenate([t[:2], np.maximum(np.exp(np.clip(t[2:4], -30, 30)), 1e-10), [1 - part, part]])

    now = moments((center > 0).astype(float))
    for _ in range(EM_STEPS):
        one, before = step(now)
        two, _ = step(one)
        if min(one[4:].min(), two[4:].min()) < 1e-8:
            return two, True
        a, b, c = free(now), free(one), free(two)
        r, v = b - a, (c - b) - (b - a)
        size = np.linalg.norm(v)
        after = two
        if size > 1e-14:
            reach = max(1.0, np.linalg.norm(r) / size)
            ahead, _ = step(bound(a + 2 * reach * r + reach**2 * v))
            _, best = step(ahead)
            if ahead[4:].min() >= 1e-8 and best >= step(two)[1]:
                after = ahead
        gained = step(after)[1] - before
        moved = np.abs(after - now).max()
        now = after
        if abs(gained) < EM_TOLERANCE * (1 + abs(before)) and moved < 1e-5:
            return now, True
    return now, False


def log_density(z: Column, params: Column) -> Column:
    """Logarithm of a two-normal density from its means, variances and parts."""

    def one(k: int) -> Column:
        far = F.pow(z - params[k], 2) / (2 * params[k + 2])
        return F.when(params[k + 4] > 0, F.log(params[k + 4]) - 0.5 * F.log(2 * float(np.pi) * params[k + 2]) - far).otherwise(F.lit(float("-inf")))

    def both(pair: Column) -> Column:
        high = F.greatest(pair[0], pair[1])
        return high + F.log1p(F.exp(F.least(pair[0], pair[1]) - high))

    return let(F.array(one(0), one(1)), both)


def mixture_fits(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """For every usable group: number of values, center and scale, and both fitted models.

    One way for groups of any size: their values are counted in at most ``CELLS`` cells of
    their range (number, sum, sum of squares), and a task fits a group from its cells, so
    what it holds does not grow with the group. Groups of fewer than five values, with a
    missing or infinite value, or without spread are left out.
    """
    keys = list(keys)
    ship_package(df.sparkSession)
    x = F.col(value).cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(bad.cast("int")).alias("_bad"), F.avg(x).alias("center"), F.stddev_pop(x).alias("scale"),
        F.min(x).alias("_low"), F.max(x).alias("_high"),
    )
    usable = hold(sizes.where((F.col("n") >= 5) & (F.col("_bad") == 0) & (F.col("scale") >= 1e-10)).drop("_bad"))
    z = (x - F.col("center")) / F.col("scale")
    width = (F.col("_high") - F.col("_low")) / F.col("scale") / CELLS
    placed = df.join(usable, keys).select(*keys, z.alias("_z"), F.floor(z / width).alias("_cell"))
    cells = placed.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_c"), F.sum("_z").alias("_s"), F.sum(F.col("_z") * F.col("_z")).alias("_q"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_cell")
        fits = [fit_mixture(pdf["_c"].to_numpy(float), pdf["_s"].to_numpy(), pdf["_q"].to_numpy(), equal) for equal in (True, False)]
        row = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame({**row, "equal": [fits[0][0].tolist()], "varying": [fits[1][0].tolist()], "converged": [fits[0][1] and fits[1][1]]})

    fields = [df.schema[k] for k in keys] + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("equal", "varying")]
    fitted = cells.groupBy(*keys).applyInPandas(solve, T.StructType([*fields, T.StructField("converged", T.BooleanType())]))
    return hold(usable.drop("_low", "_high").join(fitted, keys))


def mixture_gain(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """BIC of two Gaussians less BIC of one for each group, and whether both fits converged.

    Values are centred and scaled first, which changes no difference of BICs. The
    likelihoods are those of all values at the fitted parameters, summed by Spark. Groups
    that ``mixture_fits`` leaves out give null.
    """
    keys = list(keys)
    fits = mixture_fits(df, keys, value)
    z = (F.col(value).cast("double") - F.col("center")) / F.col("scale")
    sums = df.join(fits, keys).groupBy(*keys).agg(
        *[F.sum(log_density(z, F.col(m))).alias(f"_{m}") for m in ("equal", "varying")], F.first("n").alias("_n"), F.first("converged").alias(f"{out}_converged")
    )
    n, log_n = F.col("_n").cast("double"), F.log(F.col("_n").cast("double"))
    two = F.greatest(2 * F.col("_equal") - 4 * log_n, 2 * F.col("_varying") - 5 * log_n)
    gain = two + n * (float(np.log(2 * np.pi)) + 1) + 2 * log_n
    fitted = sums.select(*keys, gain.alias(out), f"{out}_converged")
    return df.select(*keys).distinct().join(fitted, keys, "left")


def mixture_checks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """What a good fit has, for each usable group: one more step over all values moves the second component's mean and part by no more than a little."""
    keys = list(keys)
    fits = mixture_fits(df, keys, value)
    z = (F.col(value).cast("double") - F.col("center")) / F.col("scale")
    p = F.col("varying")
    rows = df.join(fits, keys).select(*keys, "n", "varying", "converged", z.alias("z"), log_density(z, p).alias("ll"))
    second = F.exp(F.log(p[5]) - 0.5 * F.log(2 * float(np.pi) * p[3]) - F.pow(F.col("z") - p[1], 2) / (2 * p[3]) - F.col("ll"))
    share = F.when(p[5] > 0, second).otherwise(0.0)
    sums = rows.groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("converged").alias("converged"), F.first(p).alias("p"),
        F.sum(share).alias("w"), F.sum(share * F.col("z")).alias("s"), F.count(F.lit(1)).alias("seen"),
    )
    part, mean = F.col("w") / F.col("n"), F.try_divide(F.col("s"), F.col("w"))
    return sums.select(
        *keys, F.col("seen").alias("n"), "converged", (F.abs(part - F.col("p")[5]) < 1e-2).alias("parts_agree"),
        F.coalesce(F.abs(mean - F.col("p")[1]) < 2e-2, F.lit(True)).alias("means_agree"),
    )


def side_components(wins: DataFrame) -> DataFrame:
    """Each win's first offensive and defensive component within its team, a row a side."""
    keys = ["team_id", "team_short_display_name"]
    both = first_component(wins.select(*keys, *FEATURES), keys, OFFENSE, "pc_off")
    both = first_component(both, keys, DEFENSE, "pc_def").select(*keys, "pc_off", "pc_def")
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"pc_{s}").alias("pc")) for s in ("off", "def")])
    return hold(both.select(*keys, F.inline(sides)))


def shape_tests(wins: DataFrame) -> DataFrame:
    """Bimodality of each team's first offensive and defensive component."""
    keys = ["team_id", "team_short_display_name"]
    stacked = side_components(wins)
    shapes = bimodality(stacked, [*keys, "side"], "pc", "bc").join(mixture_gain(stacked, [*keys, "side"], "pc", "gain"), [*keys, "side"])
    cells = []
    for side in ("off", "def"):
        own = F.col("side") == side
        cells += [F.max(F.when(own, F.col(c))).alias(f"{n}_{side}") for c, n in (("bc", "bc"), ("gain", "bic_diff"), ("gain_converged", "converged"))]
    return shape_flags(shapes.groupBy(*keys).agg(*cells))


BIMODAL_CUT = 0.555  # fixed value


def shape_flags(result: DataFrame) -> DataFrame:
    over = {s: F.coalesce(F.col(f"bc_{s}") > BIMODAL_CUT, F.lit(False)) for s in ("off", "def")}
    return result.withColumns(
        {
            "bc_composite": mean_of_known([F.col("bc_off"), F.col("bc_def")]),
            "is_bimodal_off": over["off"],
            "is_bimodal_def": over["def"],
            "gmm_bimodal_off": F.coalesce(F.col("bic_diff_off") > 0, F.lit(False)),
            "gmm_bimodal_def": F.coalesce(F.col("bic_diff_def") > 0, F.lit(False)),
            "bimodal_both": over["off"] & over["def"],
        }
    )


def versatility_by_shape(teams: DataFrame, shapes: DataFrame) -> DataFrame:
    """Half entropy, half bimodality scaled between its smallest and largest."""
    joined = teams.join(shapes.select("team_id", "bc_composite"), "team_id")
    ends = joined.agg(F.min("bc_composite").alias("_lo"), F.max("bc_composite").alias("_hi"))
    norm = F.try_divide(F.col("bc_composite") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return (
        joined.crossJoin(F.broadcast(ends))
        .withColumn("bc_norm", norm)
        .withColumn("versatility_score", 0.5 * F.col("entropy_norm") + 0.5 * F.col("bc_norm"))
        .drop("_lo", "_hi")
    )
