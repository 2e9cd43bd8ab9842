"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimsight.llm.shared import held


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) for every node of an edge.

    ``edges`` has long columns a and b; repeated edges and loops do no harm. A round joins
    every node's larger neighbours to the least node near it, then every node's smaller
    neighbours likewise, and is one written table. A star is done in one round, a chain
    shrinks by a constant share; it ends when a round changes nothing. A node with very many
    neighbours only takes part in minima, which are combined before the shuffle, and in joins
    with one row for each node, which Spark splits.
    """
    tree = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    tree, before = held(tree, "edges"), None
    while True:
        now = tree.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("mark")).first()
        if now == before or not now["n"]:
            break
        before = now
        near = tree.select(F.col("b").alias("u"), F.col("a").alias("v")).union(tree.select("a", "b"))
        low = near.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("b"), F.least("u", "v").alias("to"))
        large = tree.join(low, "b").select("a", F.col("to").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("to"))
        small = large.join(least, "a").filter("b <> to").select(F.col("b").alias("a"), F.col("to").alias("b"))
        tree = held(small.union(least.select("a", F.col("to").alias("b"))).distinct(), "edges")
    roots = tree.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return tree.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
