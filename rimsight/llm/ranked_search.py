"""Ranked lexical search: Block-Max MaxScore over shards of compressed posting lists."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rimsight.llm import words as W
from rimsight.llm.shared import held, ship_package

TOP = 10
BLOCK = 128  # postings of a compressed block
SHARD_DOCS = 32_768
SHARD_POSTINGS = 4_000_000
STEP_DOCS = 4096  # documents of a shard that are scored before the threshold is set anew
QUERY_TERMS = 500_000  # (item, term) pairs that are searched for at a time
SLICE = 128
NO_ID = -(2**63)


@dataclass
class Queries:
    """Items as slices of (term, repeats), terms as sorted hashes with their weights."""

    hashes: np.ndarray
    start: np.ndarray
    term: np.ndarray
    repeats: np.ndarray
    weight: np.ndarray | None = None
    n: int = 0
    total: int = 0


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    hashes, ends, _ = W.word_hashes(*W.utf8(texts), W.PLAIN_SPLIT)
    return hashes, ends


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term (hash) and repeats; rows that share an id are one item with the terms of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                hashes, ends = _hashed(part.column(1))
                owner = np.repeat(np.arange(len(part)), np.diff(ends))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(hashes.view(np.int64))], ["item_id", "term"])

    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"item_id {kind}, term long").groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats"))


def term_counts(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """doc_id, n (terms with repeats) and, for the wanted terms it holds, their numbers and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        may = np.zeros(1 << 16, bool)
        may[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                found, ends = _hashed(part.column(1))
                owner = np.repeat(np.arange(len(part)), np.diff(ends))
                some = np.flatnonzero(may[(found & np.uint64(0xFFFF)).astype(np.int64)])
                place = np.minimum(np.searchsorted(wanted, found[some]), max(len(wanted) - 1, 0))
                hit = wanted[place] == found[some] if len(wanted) else np.zeros(0, bool)
                keys, counts = np.unique(owner[some[hit]] * np.int64(max(len(wanted), 1)) + place[hit], return_counts=True)
                doc, term = np.divmod(keys, max(len(wanted), 1))
                offsets = pa.array(np.searchsorted(doc, np.arange(len(part) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(np.diff(ends).astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def holders(counted: DataFrame) -> DataFrame:
    """term and df; tasks add up their own documents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(batch.column(0).flatten().to_numpy())
            if len(own) > len(df):
                df = np.append(df, np.zeros(len(own) - len(df), np.int64))
            df[: len(own)] += own
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], ["term", "df"])

    return counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Packed:
    """Blocks of BLOCK small numbers, each block in as many bits a number as its largest needs."""

    def __init__(self, values: np.ndarray):
        widths = np.frompyfunc(int.bit_length, 1, 1)(values.max(axis=1, initial=0).astype(object)).astype(np.int64)
        self.width, self.row, self.parts = widths, np.zeros(len(values), np.int64), {}
        for width in np.unique(widths).tolist():
            own = np.flatnonzero(widths == width)
            self.row[own] = np.arange(len(own))
            if width:
                bits = (values[own][:, :, None] >> np.arange(width)) & 1
                self.parts[width] = np.packbits(bits.astype(np.uint8).reshape(len(own), -1), axis=1)

    def read(self, blocks: np.ndarray) -> np.ndarray:
        out = np.zeros((len(blocks), BLOCK), np.int64)
        for width in np.unique(self.width[blocks]).tolist():
            if width:
                own = np.flatnonzero(self.width[blocks] == width)
                bits = np.unpackbits(self.parts[width][self.row[blocks[own]]], axis=1).reshape(len(own), BLOCK, width)
                out[own] = bits @ (1 << np.arange(width))
        return out


class Shard:
    """Posting lists of a bounded set of documents in id order, in compressed blocks with their largest impact."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, q: Queries):
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids = ids[order]
        self.m = 100 - 75 + (75 * n[order] * q.n) // max(q.total, 1)
        doc = place[np.repeat(np.arange(len(ids)), np.diff(ends))]
        by = np.lexsort((doc, terms))
        doc, term, count = doc[by], terms[by].astype(np.int64), counts[by].astype(np.int64)
        # a list's postings start a block of its own
        self.size = np.bincount(term, minlength=len(q.hashes))
        blocks = -(-self.size // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])
        within = np.arange(len(term)) - (np.cumsum(self.size) - self.size)[term]
        block, slot = self.first[term] + within // BLOCK, within % BLOCK
        total = int(self.first[-1])
        self.length = np.bincount(block, minlength=total)
        start = np.flatnonzero(slot == 0)
        self.begin = doc[start]
        self.last = doc[np.append(start[1:], len(doc)) - 1] if len(start) else np.zeros(0, np.int64)
        gaps = np.zeros((total, BLOCK), np.int64)
        step = np.diff(doc, prepend=0)
        step[slot == 0] = 0
        gaps[block, slot] = step
        less = np.zeros((total, BLOCK), np.int64)
        less[block, slot] = count - 1
        self.gaps, self.less = Packed(gaps), Packed(less)
        self.impact = np.maximum.reduceat(self.impacts(doc, count), start) if len(start) else np.zeros(0, np.int64)
        self.most = np.zeros(len(q.hashes), np.int64)
        np.maximum.at(self.most, term[start], self.impact)

    def impacts(self, doc: np.ndarray, count: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * count) // (1000 * count + 8 * self.m[doc])

    def postings(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks of one list, ascending; decompresses them."""
        real = np.arange(BLOCK)[None, :] < self.length[blocks][:, None]
        doc = (self.begin[blocks][:, None] + np.cumsum(self.gaps.read(blocks), axis=1))[real]
        return doc, self.impacts(doc, self.less.read(blocks)[real] + 1)


def search(shard: Shard, term: np.ndarray, factor: np.ndarray, heap: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The heap (scores, ids) after a shard.

    Lists are ordered by the most they can add (``factor`` times their largest impact). Those
    that together stay below the heap's least score are not essential: no document gets into
    the heap by them alone, so only documents of the other lists are looked at. Block maxima
    of the lists left out then reject most of these before any of their blocks is read.
    """
    some = (shard.size[term] > 0) & (factor > 0)
    term, factor = term[some], factor[some]
    bound = factor * shard.most[term]
    order = np.argsort(bound, kind="stable")
    term, factor, bound = term[order], factor[order], bound[order]
    below = np.cumsum(bound)
    read: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at in range(0, len(shard.ids), STEP_DOCS):
        end = min(at + STEP_DOCS, len(shard.ids))
        least = int(heap[0][-1]) if len(heap[0]) == TOP else 1
        essential = int(np.searchsorted(below, least, "left"))
        if essential == len(term):
            break
        score = np.zeros(end - at, np.int64)
        for k in range(essential, len(term)):
            if k not in read:
                doc, impact = shard.postings(np.arange(shard.first[term[k]], shard.first[term[k] + 1]))
                read[k] = doc, impact * factor[k]
            doc, gain = read[k]
            a, b = np.searchsorted(doc, (at, end))
            score[doc[a:b] - at] += gain[a:b]
        found = np.flatnonzero(score)
        doc, score = found + at, score[found]
        if essential:
            kept = score + below[essential - 1] >= least
            doc, score = doc[kept], score[kept]
            blocks, most = np.zeros((essential, len(doc)), np.int64), np.zeros((essential, len(doc)), np.int64)
            for k in range(essential):
                a, b = shard.first[term[k]], shard.first[term[k] + 1]
                at_block = a + np.searchsorted(shard.last[a:b], doc)
                inside = at_block < b
                inside[inside] = shard.begin[at_block[inside]] <= doc[inside]
                blocks[k] = np.where(inside, at_block, -1)
                most[k, inside] = factor[k] * shard.impact[at_block[inside]]
            hope = score + most.sum(axis=0)
            for k in range(essential - 1, -1, -1):
                kept = hope >= least
                if not kept.all():
                    doc, score, hope, blocks, most = doc[kept], score[kept], hope[kept], blocks[:, kept], most[:, kept]
                wanted = blocks[k] >= 0
                if not wanted.any():
                    continue
                listed, impact = shard.postings(np.unique(blocks[k][wanted]))
                spot = np.minimum(np.searchsorted(listed, doc), len(listed) - 1)
                gain = np.where(listed[spot] == doc, impact[spot] * factor[k], 0)
                score = score + gain
                hope = hope + gain - most[k]
        good = score >= least
        if good.any():
            scores, ids = np.append(heap[0], score[good]), np.append(heap[1], shard.ids[doc[good]])
            best = np.lexsort((ids, -scores))[:TOP]
            heap = scores[best], ids[best]
    return heap


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    waiting: list[pa.RecordBatch] = []
    docs = postings = 0

    def packed():
        table = pa.Table.from_batches(waiting).combine_chunks()
        terms, counts = (table.column(c).combine_chunks() if table.column(c).num_chunks > 1 else table.column(c).chunk(0) for c in ("terms", "counts"))
        offsets = terms.offsets.to_numpy()
        ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
        return ids, table.column("n").to_numpy(), offsets - offsets[0], terms.flatten().to_numpy(), counts.flatten().to_numpy()

    for batch in batches:
        for at in range(0, len(batch), 4096):
            part = batch.slice(at, 4096)
            waiting.append(part)
            docs += len(part)
            postings += len(part.column(2).flatten())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield packed()
                waiting, docs, postings = [], 0, 0
    if docs:
        yield packed()


def shard_tops(counted: DataFrame, queries: Queries) -> DataFrame:
    """q (number of the item), doc_id and score of the best documents of each task's shards."""
    shared = counted.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = shared.value
        none = np.zeros(0, np.int64)
        heaps = [(none, none)] * (len(q.start) - 1)
        for parts in _shards(batches):
            shard = Shard(*parts, q)
            for k, (a, b) in enumerate(zip(q.start[:-1], q.start[1:])):
                heaps[k] = search(shard, q.term[a:b], q.weight[q.term[a:b]] * q.repeats[a:b], heaps[k])
        owner = np.repeat(np.arange(len(heaps)), [len(h[0]) for h in heaps])
        ids = np.concatenate([none, *[h[1] for h in heaps]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([none, *[h[0] for h in heaps]]))], ["q", "doc_id", "score"]
        )

    return counted.filter("size(terms) > 0").mapInArrow(run, "q long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score of the TOP best documents of every item.

    Terms are found in whole texts and told apart by a 64-bit hash. Documents are counted
    once for the terms of all items; their number, length and holders are those of the whole
    table. Tasks cut the counted documents into shards of bounded size, no postings are
    shuffled, and only the best of each task and item meet in the end. Items are searched for
    in blocks of at most about QUERY_TERMS terms, which is what tasks receive.

    Null texts have no terms and blank ones none either; such items and documents give no
    rows. A null doc_id ranks before others of equal score. Rows that share a doc_id are
    documents of their own, rows that share an item_id (null too) one item. Other columns
    are not read. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    pairs = held(item_terms(items), "item-terms")
    blocks = max(1, -(-pairs.count() // QUERY_TERMS))
    results = [_block(docs, pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)) for k in range(blocks)]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _block(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    found = pairs.toArrow().combine_chunks()
    names = found.column("item_id").unique()
    owner = pa.compute.index_in(found.column("item_id"), value_set=names).to_numpy()
    raw = found.column("term").to_numpy().view(np.uint64)
    hashes, term = np.unique(raw, return_inverse=True)
    by = np.lexsort((term, owner))
    queries = Queries(hashes, np.searchsorted(owner[by], np.arange(len(names) + 1)), term[by].astype(np.int64), found.column("repeats").to_numpy()[by])
    counted = held(term_counts(docs, hashes), "term-counts")
    totals = counted.filter("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
    queries.n, queries.total = totals["n"], totals["total"] or 0
    df = np.zeros(len(hashes), np.int64)
    for row in holders(counted).toLocalIterator():
        df[row["term"]] = row["df"]
    queries.weight = np.array([math.floor(1000 * math.log((2 * queries.n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    tops = shard_tops(counted, queries).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= TOP)
    kind = pairs.schema["item_id"].dataType
    named = spark.createDataFrame(list(enumerate(names.to_pylist())), f"q long, item_id {kind.simpleString()}")
    return tops.join(F.broadcast(named), "q").select("item_id", "rank", "doc_id", "score")
