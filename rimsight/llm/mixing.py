"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rimsight.llm.columns import NOT_BLANK, fresh
from rimsight.llm.shared import held

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 17


def text_size(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_BLANK)), F.lit(0)).cast("long")


def source_offset(source: Column, seed: int = SEED) -> Column:
    """The source's random offset in [0, 1), the same in every run of one seed."""
    named = F.concat(F.lit(f"{seed}"), F.coalesce(F.concat(F.lit("="), source), F.lit("-")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / 2**32


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Target of each source: source, source_size, target.

    ``sizes`` has source and size. Sources in order of code points, null last, take the
    weights in turn and share ``share`` of all sizes; none gets over ``most`` times its own
    size, and what is over goes to the others by weight until none is above. Sources are
    filled in order of the level at which each is full, so running sums give the level at
    once. The windows here see one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    full = (F.col("source_size") * most).cast("double")
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double"))
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy(F.lit(0))
    budget = F.sum("source_size").over(everywhere) * F.lit(float(share))
    levels = weighted.withColumn(
        "level", (budget - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ).withColumn("is_full", full <= F.col("weight") * F.col("level"))
    # the first source in this order that is not full has the level of all that follow
    rest = ~F.col("is_full")
    level = F.min(F.when(rest, F.struct(F.col("source_size") / F.col("weight"), F.col("level").alias("level")))).over(everywhere)["level"]
    return levels.select(
        "source", "source_size", F.when(F.col("is_full"), full).otherwise(F.col("weight") * level).alias("target")
    )


def taken_copies(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """How often the mix takes each document row.

    Reads doc_id, source, text; returns doc_id, source, text_hash, size, source_size, target,
    copies. Every document of a source expects target / source_size copies. Within the source
    they stand by size, so the words taken stay within one largest document of the target;
    a document is taken once for every whole number that its stretch of the running sum
    (moved by the source's offset) passes: at most twice. Running sums come from the places
    in a range-partitioned order plus the rows of the ranges before, so a source of any size
    is spread over tasks.

    Null texts have size 0; a null source is a source of its own, the last; a source without
    words gets none; null ids come first; repeated rows are rows of their own.
    """
    sized = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.lit(7), F.col("text")).alias("text_hash"),
        text_size(F.col("text")).alias("size"),
    )
    order = ["source", "size", "doc_id", "text_hash"]
    ranged = held(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-sizes")
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("source", "part").agg(F.count("*").alias("n")).select(
        F.col("source").alias("in_source"), F.col("part").alias("in_part"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")
    )
    targets = source_targets(ranged.select("source", "size")).withColumnRenamed("source", "of_source")
    placed = parts.join(targets, F.col("in_source").eqNullSafe(F.col("of_source"))).drop("of_source")
    local = Window.partitionBy("part", "source").orderBy("size", "doc_id", "text_hash")
    rows = ranged.withColumn("place", F.row_number().over(local)).join(
        placed, (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("in_source"))
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = (F.col("place") + F.col("ahead")).cast("double")
    crossed = F.floor(each * place + source_offset(F.col("source"), seed)) - F.floor(
        each * (place - 1) + source_offset(F.col("source"), seed)
    )
    return rows.select("doc_id", "source", "text_hash", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every row as often as it is taken, with all its columns."""
    doc, source, text_hash, same, copies, again = fresh(docs, "doc", "of_source", "text_hash", "same", "copies", "again")

    def numbered(df: DataFrame, doc_id: str, of: str, hashed: str) -> DataFrame:
        # identical rows are told apart by a number
        return df.withColumn(same, F.row_number().over(Window.partitionBy(doc_id, of, hashed).orderBy(hashed)))

    takes = taken_copies(docs, seed).select(
        F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("text_hash").alias(text_hash), F.col("copies").alias(copies)
    )
    wanted = numbered(takes, doc, source, text_hash).filter(F.col(copies) > 0)
    left = docs.withColumns({"doc_id": F.col("doc_id"), text_hash: F.xxhash64(F.lit(7), F.col("text"))})
    left = numbered(left, "doc_id", "source", text_hash)
    joined = left.alias("l").join(
        wanted.alias("r"),
        F.col("l.doc_id").eqNullSafe(F.col(f"r.{doc}"))
        & F.col("l.source").eqNullSafe(F.col(f"r.{source}"))
        & (F.col(f"l.{text_hash}") == F.col(f"r.{text_hash}"))
        & (F.col(f"l.{same}") == F.col(f"r.{same}")),
    )
    return joined.select(*[f"l.{c}" for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"r.{copies}"))).alias(again)).drop(again)
