"""Exact top-k inner products: vectors by descending length, rotated partial sums, residual bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rimsight.llm.shared import held, ship_package, tasks_for

SCALE = 1024
TOP = 10
STEP = 1024  # candidates looked at together
QUERY_BLOCK = 256
SEEDS = 2048  # longest vectors that give every query its first bound
EXACT = 2.0**52


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the vector of floor(scale * x), for those that take part, with its squared length."""
    known = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    whole = F.transform("vector", lambda x: F.rint(F.floor(x * scale).cast("double")))
    kept = known.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select("vec_id", whole.alias("vector"))
    return kept.withColumn("length", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)))


def _matrix(column, dims: int) -> np.ndarray:
    """Rows padded with zeros to ``dims``."""
    lengths = np.fromiter((len(v) for v in column), np.int64, len(column))
    flat = np.concatenate([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros(0)
    if len(column) and (lengths == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims))
    for row, v in zip(out, column):
        row[: len(v)] = v
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, the strongest first, from their summed outer products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            rows = _matrix(batch.column(0).to_pylist(), dims)
            rows = rows / np.maximum(1.0, np.linalg.norm(rows, axis=1, keepdims=True))
            total += rows.T @ rows
        at = np.arange(dims * dims)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "value"])

    cells = vectors.select("vector").mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    gram = np.zeros(dims * dims)
    for r in cells.collect():  # dims squared numbers, whatever the number of vectors
        gram[r["at"]] = r["value"]
    return np.linalg.svd(gram.reshape(dims, dims))[0]


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole-number vectors of one count each, exact."""
    bound = np.linalg.norm(queries, axis=1).max(initial=0) * np.linalg.norm(rows, axis=1).max(initial=0)
    if bound < EXACT:
        return np.einsum("ij,ij->i", queries, rows).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(q, r)) for q, r in zip(queries, rows)]
    return np.array([max(-(2**63), min(2**63 - 1, x)) for x in exact], np.int64)


class Search:
    """Best k candidates of a block of queries, fed blocks of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, head: int, top: int, floor: np.ndarray | None = None):
        self.ids, self.vectors, self.top, self.head, self.turn = ids, vectors, top, head, turn
        rotated = vectors @ turn
        self.first, self.rest = rotated[:, :head], np.linalg.norm(rotated[:, head:], axis=1)
        self.length = np.linalg.norm(vectors, axis=1)
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf) if floor is None else floor.astype(np.float64).copy()
        self.compared = 0

    def add(self, ids: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> bool:
        """Candidates in order of length; false once no later one can count."""
        # a little more than the bound, for rounding
        slack = 1e-9 * (self.length * lengths.max(initial=0) + 1) + 1e-6
        open_ = np.flatnonzero(self.length * lengths.max(initial=0) + slack >= self.least)
        if not len(open_):
            return False
        rotated = rows @ self.turn
        partial = self.first[open_] @ rotated[:, : self.head].T
        partial += np.outer(self.rest[open_], np.linalg.norm(rotated[:, self.head :], axis=1))
        q, c = np.nonzero(partial + slack[open_, None] >= self.least[open_, None])
        q = open_[q]
        own = self.ids[q] != ids[c]
        q, c = q[own], c[own]
        self.compared += len(q)
        for at in range(0, len(q), 1 << 16):
            qs, cs = q[at : at + (1 << 16)], c[at : at + (1 << 16)]
            score = products(self.vectors[qs], rows[cs])
            order = np.lexsort((ids[cs], -score, qs))
            cut = np.flatnonzero(np.diff(qs[order], prepend=-1))
            for a, b in zip(cut, [*cut[1:], len(order)]):
                best = order[a : min(b, a + self.top)]
                k = int(qs[best[0]])
                merged = sorted(self.found[k] + [(-int(score[i]), int(ids[cs[i]])) for i in best])[: self.top]
                self.found[k] = merged
                if len(merged) == self.top:
                    self.least[k] = max(self.least[k], -merged[-1][0])
        return True


def top_products(vectors: DataFrame, every: int = 100, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """For each vector whose id is divisible by ``every``, the ``top`` largest inner products.

    Reads vec_id and embedding; returns query_id, rank, vec_id, score. Components become
    floor(scale * x) and products are whole numbers. Vectors that are null, hold a null or
    non-finite component, or have no id take no part; of vectors of unequal size the shorter
    counts as zero beyond its end. Ties go to the smaller id; repeated ids are candidates of
    their own except for a query of that id. Products beyond a long are cut at its ends.

    The longest vectors, a fixed number, give each query a lower bound for its k-th score.
    Candidates are dealt over tasks; each task goes through its own by descending length in
    blocks against blocks of queries, drops what Cauchy-Schwarz rules out, by length first
    and then by the rotated partial sum plus the residual's bound, and counts the rest
    exactly. Every task passes on at most ``top`` rows a query.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = held(scaled(vectors, scale), "whole-vectors")
    shape = rows.agg(F.max(F.size("vector")).alias("dims"), F.count("*").alias("n")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not shape["n"]:
        return spark.createDataFrame([], schema)
    dims = max(1, shape["dims"])
    turn = rotation(rows, dims)
    head = max(1, dims // 4)
    shared = spark.sparkContext.broadcast(turn)  # dims squared numbers
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id"), "vector")
    longest = rows.orderBy(F.desc("length"), "vec_id").limit(SEEDS).toPandas()  # a fixed number of rows
    seeds = spark.sparkContext.broadcast(
        (longest["vec_id"].to_numpy(np.int64), _matrix(list(longest["vector"]), dims), longest["length"].to_numpy(np.float64))
    )

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed_ids, seed_rows, seed_lengths = seeds.value
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                part = batch.slice(at, QUERY_BLOCK)
                search = Search(part.column(0).to_numpy(), _matrix(part.column(1).to_pylist(), dims), shared.value, head, top)
                for k in range(0, len(seed_ids), STEP):
                    if not search.add(seed_ids[k : k + STEP], seed_rows[k : k + STEP], seed_lengths[k : k + STEP]):
                        break
                floor = pa.array(search.least, pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), floor], ["vec_id", "vector", "floor"])

    bounded = held(asked.mapInArrow(bound, "vec_id long, vector array<double>, floor double"), "bounded-queries")
    n_tasks = tasks_for(spark)
    # every block of queries meets every share of the candidates once
    blocks = bounded.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(n_tasks - 1))))
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_tasks)).cast("int"))

    def search_share(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        order = candidates.sort_values(["length", "vec_id"], ascending=[False, True])
        ids, lengths = order["vec_id"].to_numpy(np.int64), order["length"].to_numpy(np.float64)
        matrix = _matrix(list(order["vector"]), dims)
        out = []
        for at in range(0, len(queries), QUERY_BLOCK):
            part = queries.iloc[at : at + QUERY_BLOCK]
            search = Search(
                part["vec_id"].to_numpy(np.int64), _matrix(list(part["vector"]), dims), shared.value, head, top, part["floor"].to_numpy(np.float64)
            )
            for k in range(0, len(ids), STEP):
                if not search.add(ids[k : k + STEP], matrix[k : k + STEP], lengths[k : k + STEP]):
                    break
            out += [(int(q), -s, v) for q, best in zip(search.ids, search.found) for s, v in best]
        return pd.DataFrame(out, columns=["query_id", "score", "vec_id"]).astype("int64")

    merged = (
        blocks.groupBy("share").cogroup(dealt.groupBy("share")).applyInPandas(search_share, "query_id long, score long, vec_id long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
