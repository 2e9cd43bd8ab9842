"""Benchmark decontamination: winnowed fingerprints, joined with the benchmark's, then extended."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimsight.llm import words as W
from rimsight.llm.columns import doc_key
from rimsight.llm.shared import held, ship_package
from rimsight.llm.sieve import passes, sieve_of

WINDOW = 10
GRAM = 5
SIEVE_BITS = 1 << 25


def winnow(hashes: np.ndarray, texts: np.ndarray, gram: int, span: int) -> np.ndarray:
    """Places of the least gram hash in every run of ``span`` grams of one text.

    Any ``gram + span - 1`` words in a row hold at least one such place, and which one it is
    depends on those words alone: the rightmost of equal hashes.
    """
    n = len(hashes) - gram + 1
    if n < span:
        return np.zeros(0, np.int64)
    values = W.grams(hashes, gram)[:n]
    runs = sliding_window_view(values, span)
    least = np.arange(len(runs)) + span - 1 - np.argmin(runs[:, ::-1], axis=1)
    whole = texts[: len(runs)] == texts[gram + span - 2 : gram + span - 2 + len(runs)]
    return np.unique(least[whole])


def _window(hashes: np.ndarray, size: int) -> np.ndarray:
    return W.grams(hashes, size)[: max(0, len(hashes) - size + 1)].view(np.int64)


def benchmark_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM, unnamed: bool = False) -> DataFrame:
    """One row per fingerprint and per window that holds it: length, fingerprint, before, window hash, item.

    An item of fewer words than ``window``, but not none, is one window of its own length;
    its fingerprint is the gram of all its words. Null texts and items without words give none.
    Items without an id have windows only if ``unnamed``; their item is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            hashes, offsets, _ = W.word_hashes(*W.utf8(batch.column(1)), W.PLAIN_SPLIT)
            rows: list[tuple] = []
            for k in range(len(ids)):
                own = hashes[offsets[k] : offsets[k + 1]]
                size = min(len(own), window)
                if not size:
                    continue
                g, span = (gram, window - gram + 1) if size == window else (size, 1)
                windows = _window(own, size)
                prints = W.grams(own, g).view(np.int64)
                for at in winnow(own, np.zeros(len(own), np.int64), g, span).tolist():
                    for start in range(max(0, at - (size - g)), min(at, len(windows) - 1) + 1):
                        rows.append((size, int(prints[at]), at - start, int(windows[start]), ids[k].as_py()))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], ["size", "print", "before", "window", "item"]
            )

    rows = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    schema = "size int, print long, before int, window long, item string"
    return (rows if unnamed else rows.filter(F.col("item").isNotNull())).mapInArrow(run, schema).distinct()


def document_prints(docs: DataFrame, sizes: list[int], sieve: bytes, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row its number of words and those fingerprints that pass the sieve, with their surroundings.

    Every fingerprint carries the hashes of all windows that hold it, so hits are extended
    where the benchmark's rows are, without the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sieve)
    out = pa.struct([("size", pa.int32()), ("print", pa.int64()), ("before", pa.int32()), ("window", pa.int64()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for at in range(0, len(batch), 512):  # the hashes of few texts at a time
                part = batch.slice(at, 512)
                hashes, offsets, _ = W.word_hashes(*W.utf8(part.column(2)), W.PLAIN_SPLIT)
                counts = np.diff(offsets)
                texts = np.repeat(np.arange(len(counts)), counts)
                found: list[list[np.ndarray]] = [[] for _ in range(6)]
                for size in sizes:
                    g, span = (gram, window - gram + 1) if size == window else (size, 1)
                    places = winnow(hashes, texts, g, span)
                    prints = W.grams(hashes, g).view(np.int64)[places]
                    passed = passes(marks, np.mod(prints, len(marks) * 8))
                    places, prints = places[passed], prints[passed]
                    windows = _window(hashes, size)
                    for before in range(size - g + 1):
                        start = places - before
                        ok = (start >= 0) & (start < len(windows))
                        ok[ok] = (texts[start[ok]] == texts[places[ok]]) & (texts[start[ok] + size - 1] == texts[places[ok]])
                        start = start[ok]
                        for k, v in enumerate((texts[start], np.full(len(start), size), prints[ok], np.full(len(start), before), windows[start], start - offsets[texts[start]])):
                            found[k].append(v)
                doc, *cols = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
                order = np.argsort(doc, kind="stable")
                flat = pa.StructArray.from_arrays([pa.array(c[order], t.type) for c, t in zip(cols, out)], fields=list(out))
                ends = np.zeros(len(counts) + 1, np.int32)
                np.cumsum(np.bincount(doc, minlength=len(counts)), out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat)],
                    ["doc_id", "text_hash", "n_words", "prints"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.lit(7), "text").alias("text_hash"), F.col("text").cast("string"))
    schema = "doc_id long, text_hash long, n_words long, prints array<struct<size:int,print:long,before:int,window:long,start:long>>"
    return rows.mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM, unnamed: bool = False) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, hit spans, words hit, items found.

    A document word is hit when it lies in an occurrence of any ``window`` words in a row of a
    benchmark item. Exact for every window: winnowing keeps one fingerprint in each.

    The benchmark's fingerprints go into a sieve of fixed size (``SIEVE_BITS``), which is all
    that is broadcast; fingerprints that pass it meet the benchmark in a shuffled join. A
    larger benchmark only lets more through. Null texts have no words; a null doc_id is kept;
    rows with equal id and text give equal results. Items without an id (null) count only if
    ``unnamed``: their words are hit, and the list of items leaves them out.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = held(benchmark_windows(items, window, gram, unnamed), "benchmark-windows")
    sieve = sieve_of(known, F.pmod(F.col("print"), F.lit(SIEVE_BITS)), SIEVE_BITS)
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # at most ``window`` lengths
    found = held(document_prints(docs, sizes, sieve, window, gram), "document-prints")
    rows = found.select(doc_key("doc_id").alias("doc"), "text_hash", F.explode("prints").alias("p")).select("doc", "text_hash", "p.*")
    hits = rows.join(known, ["size", "print", "before", "window"]).select("doc", "text_hash", "size", "start", "item")
    items_of = hits.select("doc", "text_hash", "item").distinct().groupBy("doc", "text_hash").agg(F.sort_array(F.collect_list("item")).alias("items"))
    spans = (
        hits.groupBy("doc", "text_hash", "start")
        .agg(F.max("size").alias("size"))
        .groupBy("doc", "text_hash")
        .agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans"))
    )
    # words covered by overlapping spans: each adds what lies beyond the end reached so far
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["size"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["start"] + s["size"] - F.greatest(acc["end"], s["start"]))).alias("n"),
        ),
    )["n"]
    ends = spans.join(items_of, ["doc", "text_hash"]).select("doc", "text_hash", "spans", covered.alias("n_hit"), "items")
    left = found.select("doc_id", "text_hash", "n_words", doc_key("doc_id").alias("doc"))
    return left.join(ends, ["doc", "text_hash"], "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,size:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean(docs: DataFrame, items: DataFrame, unnamed: bool = False) -> DataFrame:
    """Documents without a word hit, with all their columns; the text is judged whole, ``unnamed`` as in ``contamination``."""
    hit = contamination(docs, items, unnamed=unnamed).filter(F.col("n_hit") > 0)
    marks = hit.select(doc_key("doc_id").alias("hit_doc"), F.col("text_hash").alias("hit_hash")).distinct()
    same = (doc_key("d.doc_id") == F.col("m.hit_doc")) & (F.xxhash64(F.lit(7), F.col("d.text")) == F.col("m.hit_hash"))
    return docs.alias("d").join(marks.alias("m").hint("shuffle_hash"), same, "left_anti")
