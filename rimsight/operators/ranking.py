"""Ranks, scores and neighbours over whole results, without one-task windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimsight.session import hold

BUCKETS = 128
SHARES = 1_000


def z_score(df: DataFrame, column: str, out: str, flat: float | None = None) -> DataFrame:
    """Distance from the mean in sample deviations; ``flat`` when there is none."""
    # exactly one row, so the broadcast is bounded
    stats = df.agg(F.avg(column).alias("_m"), F.stddev_samp(column).alias("_s"))
    z = F.when(F.col("_s") > 0, (F.col(column) - F.col("_m")) / F.col("_s"))
    if flat is not None:
        z = z.otherwise(F.lit(float(flat)))
    return df.crossJoin(F.broadcast(stats)).withColumn(out, z).drop("_m", "_s")


def _value_positions(df: DataFrame, column: str, descending: bool = False, within: Sequence[str] = ()) -> DataFrame:
    """Each different value with its count and the number of rows before it.

    Values are counted first, so a value held by a third of the rows is one
    row. Distinct values are cut into ``BUCKETS`` ranges at approximate
    quantiles; each range is summed on its own task and the ranges before it
    come from a table of at most ``BUCKETS`` rows. The cuts only balance the
    work: positions are exact wherever they fall. ``within`` columns have few
    values (the columns of a matrix), each positioned on its own.
    """
    keys = list(within)
    value = F.col(column)
    counts = df.where(value.isNotNull()).groupBy(*keys, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("_v", [i / BUCKETS for i in range(1, BUCKETS)], 2000).alias("_cuts")
    )
    cut = counts.join(F.broadcast(cuts), keys) if keys else counts.crossJoin(F.broadcast(cuts))
    placed = cut.select(*keys, "_v", "_n", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_b"))
    order = F.desc if descending else F.asc
    before = placed.groupBy(*keys, "_b").agg(F.sum("_n").alias("_size"))
    sooner = Window.partitionBy(*keys).orderBy(order("_b")).rowsBetween(Window.unboundedPreceding, -1)
    before = before.select(*keys, "_b", F.sum("_size").over(sooner).alias("_before"))
    inside = Window.partitionBy(*keys, "_b").orderBy(order("_v")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return placed.join(F.broadcast(before), [*keys, "_b"]).select(
        *keys, "_v", "_n", (F.coalesce("_before", zero) + F.coalesce(F.sum("_n").over(inside), zero)).alias("_at")
    )


def average_rank(df: DataFrame, column: str, out: str, descending: bool = False, within: Sequence[str] = ()) -> DataFrame:
    """Rank from 1 over all rows, ties sharing their mean position."""
    places = hold(_value_positions(df, column, descending, within))
    keys = [F.col(k).alias(f"_g{i}") for i, k in enumerate(within)]
    ranks = places.select(*keys, "_v", "_n", (F.col("_at") + (F.col("_n") + 1) / 2).alias(out))
    same = F.col(column) == F.col("_v")
    for i, k in enumerate(within):
        same = same & (F.col(k) == F.col(f"_g{i}"))
    # a value with a large share of the rows would send them all to one task: at most SHARES values have that many
    limit = F.broadcast(places.agg((F.sum("_n") / SHARES).alias("_limit")))
    cut = ranks.crossJoin(limit).withColumn("_many", F.col("_n") > F.col("_limit")).drop("_n", "_limit")
    common = F.broadcast(cut.where("_many").drop("_many"))
    rare = cut.where(~F.col("_many")).drop("_many")
    found = df.join(common, same).unionByName(df.join(common, same, "left_anti").join(rare, same, "left"))
    return found.drop("_v", *[f"_g{i}" for i in range(len(within))])


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """Exact quantiles by linear interpolation, one row per share.

    The values at the two neighbouring positions are looked up in the counted
    values; the built-in exact aggregate would gather them all in one task.
    """
    places = hold(_value_positions(df, column))
    total = places.agg(F.sum("_n").alias("_all"))
    wanted = F.array(*[F.lit(float(q)) for q in shares])
    asked = places.crossJoin(F.broadcast(total)).withColumn("q", F.explode(wanted))
    spot = (F.col("_all") - 1) * F.col("q")
    low, end = F.floor(spot), F.col("_at") + F.col("_n")
    has_low = (F.col("_at") <= low) & (low < end)
    has_high = (F.col("_at") <= F.ceil(spot)) & (F.ceil(spot) < end)
    near = asked.where(has_low | has_high)
    return near.groupBy("q").agg(
        F.max(F.when(has_low, F.col("_v"))).alias("_low"),
        F.max(F.when(has_high, F.col("_v"))).alias("_high"),
        F.max(spot - low).alias("_part"),
    ).select("q", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("value"))


def percentile(df: DataFrame, column: str, out: str) -> DataFrame:
    """Average rank as a share of all rows, times 100."""
    total = df.agg(F.count(column).alias("_all"))
    ranked = average_rank(df, column, "_r").crossJoin(F.broadcast(total))
    return ranked.withColumn(out, F.col("_r") / F.col("_all") * 100).drop("_r", "_all")


def top_with_ties(df: DataFrame, column: str, n: int, within: Sequence[str] = ()) -> DataFrame:
    """The n largest, keeping every row tied with the last one.

    Spark trims each task to its own top n before the shuffle for this filter.
    """
    window = Window.partitionBy(*within).orderBy(F.desc(column))
    return df.withColumn("_r", F.rank().over(window)).where(F.col("_r") <= n).drop("_r")


def bottom_with_ties(df: DataFrame, column: str, n: int, within: Sequence[str] = ()) -> DataFrame:
    """The n smallest, keeping ties."""
    window = Window.partitionBy(*within).orderBy(F.asc(column))
    return df.withColumn("_r", F.rank().over(window)).where(F.col("_r") <= n).drop("_r")


def number_rows(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """1, 2, 3, ... in a global order, numbered in parallel.

    Rows are range-sorted (equal leading values may span tasks), the sorted
    rows are held, and each task's offset is the size of the tasks before it.
    """
    placed = hold(
        df.sort(*order)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    # one row per task
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_task",
        F.coalesce(
            F.sum("_size").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    return (
        placed.join(F.broadcast(offsets), "_task")
        .withColumn(out, (F.col("_before") + F.col("_at") + 1).cast("long"))
        .drop("_task", "_at", "_before")
    )


def next_in_order(
    df: DataFrame, key: str, major: str, minor: Sequence[Column], take: dict[str, str]
) -> DataFrame:
    """``lead`` within ``key`` ordered by ``major`` (nulls last) then ``minor``.

    The lead runs inside (key, major), so one key with a third of all rows is
    spread over its major values. The row after the last of each group is the
    first of the key's next group, taken from a table with one row per group.
    ``take`` maps source column to output column.
    """
    group = Window.partitionBy(key, major).orderBy(*minor)
    marks = [c.alias(f"m{i}") for i, c in enumerate(minor)]
    payload = F.struct(*[F.col(s).alias(o) for s, o in take.items()])
    inside = df.withColumn("_in", F.lead(payload).over(group))
    heads = df.groupBy(key, major).agg(F.min_by(payload, F.struct(*marks)).alias("_head"))
    heads = heads.select(
        F.col(key).alias("_k"),
        F.col(major).alias("_m"),
        F.lead("_head").over(Window.partitionBy(key).orderBy(F.asc_nulls_last(major))).alias("_next"),
    )
    joined = inside.join(heads, (F.col(key) == F.col("_k")) & F.col(major).eqNullSafe(F.col("_m")), "left")
    follow = F.coalesce("_in", "_next")
    return joined.select(*df.columns, *[follow[o].alias(o) for o in take.values()])
