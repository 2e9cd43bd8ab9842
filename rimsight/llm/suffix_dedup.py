"""Removal of repeated byte strings by prefix-free parsing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rimsight.llm import words as W
from rimsight.llm.columns import doc_key
from rimsight.llm.shared import held, ship_package
from rimsight.llm.sieve import bits_for, passes, sieve_of

LENGTH = 100  # bytes of a repeated string
GRAM = 8  # bytes of the rolling hash
REACH = 64  # a trigger follows each start within so many bytes
SURE = LENGTH - REACH + 1  # bytes from a trigger on that any of its strings holds
PIECE = 1 << 18
MOST_BITS = 1 << 28
CONTEXT = LENGTH + REACH
CHUNK_ROWS = 60_000
GROUP_ROWS = 60_000  # phrases of a group that one task settles at once; larger groups go start by start
STARTS_ROWS = 4_000  # phrases of larger groups whose starts are written out together

_LOW48 = np.uint64((1 << 48) - 1)
_U64 = np.uint64


def phrases(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Phrases of the texts: (text, first start, last start, trigger, hash from the trigger, hash of all).

    The trigger of the string of LENGTH bytes at a start is the first place of the least
    rolling hash among its first REACH places: it depends on that string alone. Starts in a
    row with one trigger make a phrase, which reaches from its first start to the end of its
    last string. Equal strings lie in phrases whose triggers are followed by SURE equal bytes
    at least. Long texts are worked on in pieces; a phrase cut there is two with one trigger.
    """
    n = len(ends) - 1
    at = 0
    while at < n:
        # as many texts as fit, or a single long one
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE, "right")) - 1)
        begin, end = int(ends[at]), int(ends[to])
        for p in range(begin, max(end - LENGTH + 1, begin), PIECE if to == at + 1 else max(end - begin, 1)):
            stop = end if to > at + 1 else min(end, p + PIECE + LENGTH - 1)
            found = _piece(data[p:stop], ends[at : to + 1] - p)
            if found is not None:
                text, lo, hi, trigger, sure, whole = found
                shift = p - ends[at + text]
                yield text + at, lo + shift, hi + shift, trigger + shift, sure, whole
        at = to


def _piece(part: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...] | None:
    n = len(part)
    if n < LENGTH:
        return None
    power, inverse = W._powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(W._BYTE[part] * power[:n], out=sums[1:])
    rolling = W.mix((sums[GRAM:] - sums[: n - GRAM + 1]) * inverse[: n - GRAM + 1])
    least = ((rolling >> _U64(20)) << _U64(20)) | np.arange(len(rolling), dtype=np.uint64)
    width = 1
    while width < REACH:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    starts = np.arange(n - LENGTH + 1)
    text = np.searchsorted(ends, starts, "right") - 1
    inside = starts + LENGTH <= ends[np.minimum(text + 1, len(ends) - 1)]
    starts, text = starts[inside], text[inside]
    if not len(starts):
        return None
    trigger = (least[starts] & _U64((1 << 20) - 1)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    lo, hi, trigger, text = starts[first], starts[last], trigger[first], text[first]
    sure = W.mix((sums[trigger + SURE] - sums[trigger]) * inverse[trigger]) & _LOW48
    shape = ((hi - lo) * 1024 + (trigger - lo) + 1).astype(np.uint64)
    whole = W.mix(W.mix((sums[hi + LENGTH] - sums[lo]) * inverse[lo]) + shape) & _LOW48
    return text, lo, hi, trigger, sure.view(np.int64), whole.view(np.int64)


def _every_phrase(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    data, ends = W.utf8(column)
    found = list(phrases(data, ends))
    if not found:
        return [np.zeros(0, np.int64) for _ in range(6)], data, ends
    return [np.concatenate(c) for c in zip(*found)], data, ends


def parse(rows: DataFrame) -> DataFrame:
    """One row per phrase: doc, lo, hi, trigger, sure, whole; a repeat within a batch of rows has no hashes.

    Of equal phrases that a task sees together all but the first repeat an earlier one, so
    they are settled there, joined to runs of starts, and only one goes on: what many
    documents share is combined before it is shuffled.
    """
    kinds = pa.schema([("doc", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("trigger", pa.int32()), ("sure", pa.int64()), ("whole", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (text, lo, hi, trigger, sure, whole), _, _ = _every_phrase(batch.column(1))
            doc = batch.column(0).to_numpy()[text]
            order = np.lexsort((trigger, doc, whole, sure))
            s, w = sure[order], whole[order]
            again = np.zeros(len(order), bool)
            again[1:] = (s[1:] == s[:-1]) & (w[1:] == w[:-1])
            firsts, repeats = order[~again], order[again]
            cols = [doc, lo, hi, trigger, sure, whole]
            yield pa.RecordBatch.from_arrays([pa.array(c[firsts], f.type) for c, f in zip(cols, kinds)], schema=kinds)
            if len(repeats):
                doc_r, lo_r, hi_r = joined_runs(doc[repeats], lo[repeats], hi[repeats])
                none = pa.nulls(len(doc_r), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_r), pa.array(lo_r, pa.int32()), pa.array(hi_r, pa.int32()), pa.nulls(len(doc_r), pa.int32()), none, none], schema=kinds
                )

    return rows.mapInArrow(run, "doc long, lo int, hi int, trigger int, sure long, whole long")


def joined_runs(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts with those that follow on each other joined."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + 1)
    first = np.flatnonzero(new)
    return doc[first], lo[first], np.maximum.reduceat(hi, first) if len(first) else hi


def _slot(doc: Column, trigger: Column, bits: int) -> Column:
    spread = doc.bitwiseAND(F.lit(2**31 - 1)) * F.lit(2654435761)
    return (spread + trigger).bitwiseAND(F.lit(bits - 1))


def _contexts(rows: DataFrame, sieve: bytes, bits: int) -> DataFrame:
    """Phrases that pass the sieve, with their bytes."""
    shared = rows.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            (text, lo, hi, trigger, sure, whole), data, ends = _every_phrase(batch.column(1))
            doc = batch.column(0).to_numpy()[text]
            slot = ((doc & (2**31 - 1)) * 2654435761 + trigger) & (bits - 1)
            kept = np.flatnonzero(passes(marks, slot))
            for at in range(0, len(kept), 20_000):
                k = kept[at : at + 20_000]
                size = hi[k] - lo[k] + LENGTH
                owner, place = W.segments(size)
                flat = data[(ends[text[k]] + lo[k])[owner] + place]
                bounds = np.zeros(len(k) + 1, np.int32)
                np.cumsum(size, out=bounds[1:])
                raw = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[k]), *(pa.array(c[k], pa.int32()) for c in (lo, hi, trigger)), pa.array(sure[k]), pa.array(whole[k]), raw],
                    ["doc", "lo", "hi", "trigger", "sure", "whole", "context"],
                )

    return rows.mapInArrow(run, "doc long, lo int, hi int, trigger int, sure long, whole long, context binary")


def repeated_starts(sure: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, trigger: np.ndarray, contexts: list[bytes]) -> np.ndarray:
    """For each phrase and each distance of a start before the trigger: has an earlier string the same bytes?

    The parse: what follows the triggers is sorted, and neighbours' common prefixes cut the
    order into runs of equal first bytes for every length. The dictionary: what precedes
    them is ranked one byte after the other, which sorts the phrases' suffixes. A string is
    its suffix of the phrase and the run of what follows; of equal strings the first in
    corpus order stays.
    """
    n = len(doc)
    before, after = trigger - lo, hi - trigger + LENGTH
    size = np.fromiter(map(len, contexts), np.int64, n)
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.cumsum(size) - size
    right = np.zeros((n, LENGTH), np.uint8)
    owner, place = W.segments(np.minimum(after, LENGTH))
    right[owner, place] = flat[(begin + before)[owner] + place]
    left = np.zeros((n, REACH), np.uint8)
    owner, place = W.segments(before)
    left[owner, place] = flat[(begin + before)[owner] - 1 - place]
    # by length last: a short context stands before those that continue it, with NUL bytes too
    order = np.lexsort((after, _ranks(right), sure))
    # bytes in common with the phrase before in this order; none across groups
    same = right[order[1:]] == right[order[:-1]]
    common = np.where(same.all(axis=1), LENGTH, (~same).argmax(axis=1))
    common = np.minimum(common, np.minimum(after[order[1:]], after[order[:-1]]))
    common[sure[order[1:]] != sure[order[:-1]]] = -1
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    in_corpus = np.empty(n, np.int64)
    in_corpus[np.lexsort((trigger, doc))] = np.arange(n)
    out = np.zeros((n, REACH), bool)
    suffix = np.zeros(n, np.int64)
    for a in range(REACH):
        owns = np.flatnonzero((before >= a) & (trigger - hi <= a))
        if len(owns):
            run = np.concatenate([[0], np.cumsum(common < LENGTH - a)])[rank[owns]]
            by = np.lexsort((in_corpus[owns], run, suffix[owns]))
            s, r = suffix[owns][by], run[by]
            later = np.zeros(len(by), bool)
            later[1:] = (s[1:] == s[:-1]) & (r[1:] == r[:-1])
            out[owns[by[later]], a] = True
        # one more byte to the left; phrases that do not reach so far drop out above
        suffix = np.unique(suffix * 256 + left[:, a], return_inverse=True)[1]
    return out


def _ranks(rows: np.ndarray) -> np.ndarray:
    """Rank of each row of bytes among all rows."""
    keys = np.ascontiguousarray(rows).view(">u4").astype(np.uint32)  # four bytes at a time
    order = np.lexsort(keys.T[::-1])
    sorted_ = keys[order]
    new = np.ones(len(rows), np.int64)
    new[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
    out = np.empty(len(rows), np.int64)
    out[order] = np.cumsum(new)
    return out


def _settle(contexts: DataFrame) -> DataFrame:
    """doc, lo, hi of the runs of repeated starts, group by group of what follows the triggers."""

    def settle(rows: pa.Table) -> pa.RecordBatch | None:
        doc, lo, hi, trigger, sure = (rows.column(c).to_numpy().astype(np.int64) for c in ("doc", "lo", "hi", "trigger", "sure"))
        marks = repeated_starts(sure, doc, lo, hi, trigger, rows.column("context").to_pylist())
        owner, a = np.nonzero(marks)
        if not len(owner):
            return None
        start = trigger[owner] - a
        doc_r, lo_r, hi_r = joined_runs(doc[owner], start, start)
        return pa.RecordBatch.from_arrays([pa.array(doc_r), pa.array(lo_r, pa.int32()), pa.array(hi_r, pa.int32())], ["doc", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n < CHUNK_ROWS:
                continue
            rows = pa.Table.from_batches(waiting)
            sure = rows.column("sure").to_numpy()
            cut = int(np.searchsorted(sure, sure[-1], "left"))  # the last group may go on
            if cut:
                made = settle(rows.slice(0, cut))
                if made is not None:
                    yield made
                waiting, n = rows.slice(cut).to_batches(), len(rows) - cut
        if n:
            made = settle(pa.Table.from_batches(waiting))
            if made is not None:
                yield made

    return contexts.repartition("sure").sortWithinPartitions("sure").mapInArrow(run, "doc long, lo int, hi int")


def _settle_starts(contexts: DataFrame) -> DataFrame:
    """As ``_settle``, for groups of any size: equal strings meet, not the phrases of a group.

    What repeats among phrases that a task has at hand is settled there; of the other starts
    each is a row with its bytes, sorted by them, and all but the first of equal ones repeat.
    """

    def write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), STARTS_ROWS):
                rows = batch.slice(at, STARTS_ROWS)
                doc, lo, hi, trigger, sure = (rows.column(rows.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in ("doc", "lo", "hi", "trigger", "sure"))
                contexts = rows.column(rows.schema.get_field_index("context")).to_pylist()
                marks = repeated_starts(sure, doc, lo, hi, trigger, contexts)
                owner, a = np.nonzero(marks)
                start = trigger[owner] - a
                doc_r, lo_r, hi_r = joined_runs(doc[owner], start, start)
                owner, place = W.segments(hi - lo + 1)
                open_ = ~marks[owner, (trigger - lo)[owner] - place]
                owner, place = owner[open_], place[open_]
                size = np.fromiter(map(len, contexts), np.int64, len(rows))
                first = (np.cumsum(size) - size)[owner] + place
                flat = np.frombuffer(b"".join(contexts), np.uint8)
                strings = sliding_window_view(flat, LENGTH)[first].tobytes()
                bounds = (np.arange(len(owner) + 1) * LENGTH).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(strings)])
                for d, x, y, bytes_ in ((doc_r, lo_r, hi_r, pa.nulls(len(doc_r), pa.binary())), (doc[owner], lo[owner] + place, lo[owner] + place, raw)):
                    yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(x, pa.int32()), pa.array(y, pa.int32()), bytes_], ["doc", "lo", "hi", "string"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            settled = batch.column(3).is_null().to_numpy(zero_copy_only=False)
            rows = batch.filter(pa.array(~settled))
            again = np.zeros(len(rows), bool)
            if len(rows):
                strings = np.frombuffer(b"".join(rows.column(3).to_pylist()), np.uint8).reshape(len(rows), LENGTH)
                again[0] = last == strings[0].tobytes()
                again[1:] = (strings[1:] == strings[:-1]).all(axis=1)
                last = strings[-1].tobytes()
            gone = pa.concat_batches([batch.filter(pa.array(settled)), rows.filter(pa.array(again))])
            doc, lo, hi = joined_runs(*(gone.column(c).to_numpy().astype(np.int64) for c in range(3)))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["doc", "lo", "hi"])

    starts = contexts.mapInArrow(write_out, "doc long, lo int, hi int, string binary")
    spread = F.when(F.col("string").isNull(), F.xxhash64("doc")).otherwise(F.xxhash64("string"))
    return starts.repartition(spread).sortWithinPartitions("string", "doc", "lo").mapInArrow(mark, "doc long, lo int, hi int")


def repeated_runs(rows: DataFrame) -> DataFrame:
    """doc, lo, hi: runs of starts whose string of LENGTH bytes also starts earlier.

    ``rows`` has doc (a number of each text's own, in corpus order) and text.
    """
    parsed = held(parse(rows), "phrases")
    settled = parsed.filter("sure is null").select("doc", "lo", "hi")
    same = Window.partitionBy("sure", "whole")
    group = Window.partitionBy("sure")
    place = F.struct("doc", "trigger", "lo")
    grouped = parsed.filter("sure is not null").repartition("sure")
    met = grouped.withColumns({"first": F.min(place).over(same)}).withColumns(
        {
            "n": F.count("*").over(group),
            "mixed": F.min("whole").over(group) != F.max("whole").over(group),
            "large": F.count(F.when(place == F.col("first"), 1)).over(group) > GROUP_ROWS,
        }
    )
    repeated = held(
        met.filter("n > 1").select("doc", "lo", "hi", "trigger", "sure", "whole", (place != F.col("first")).alias("again"), "mixed", "large"), "repeated"
    )
    copies = repeated.filter("again").select("doc", "lo", "hi")
    out = settled.unionByName(copies)
    mixed = repeated.filter("mixed and not again")
    keys = ["doc", "lo", "hi", "trigger", "sure", "whole"]
    for r in mixed.groupBy("large").count().collect():  # two rows at most
        wanted = mixed.filter(F.col("large") == r["large"]).select(*keys)
        bits = bits_for(r["count"], MOST_BITS)
        sieve = sieve_of(wanted, _slot(F.col("doc"), F.col("trigger"), bits), bits)
        contexts = _contexts(rows, sieve, bits).join(wanted, keys, "left_semi")
        out = out.unionByName((_settle_starts if r["large"] else _settle)(contexts))
    return out


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, text) with doc, a number for each different id and text in order of ids; and each such text once.

    The number is the id itself where no id repeats.
    """
    hashed = docs.withColumns({"key": doc_key("doc_id"), "hash": F.xxhash64(F.lit(7), F.col("text"))})
    if hashed.groupBy("key").count().filter("count > 1").isEmpty():
        rows = docs.withColumn("doc", doc_key("doc_id"))
        return rows, rows
    keys = hashed.select("key", "hash").distinct()
    ordered = held(keys.repartitionByRange("key", "hash").withColumn("part", F.spark_partition_id()), "ids")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    parts = ordered.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead"))
    local = F.row_number().over(Window.partitionBy("part").orderBy("key", "hash"))
    number = ordered.withColumn("local", local).join(parts, "part").select("key", "hash", (F.col("local") + F.col("ahead")).alias("doc"))
    rows = hashed.join(number, ["key", "hash"]).select("doc_id", "text", "doc")
    return rows, rows.dropDuplicates(["doc"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start and end of the removed runs) and kept (the bytes that remain).

    Reads doc_id and text. A byte goes if a string of LENGTH bytes that covers it also starts
    earlier: in a document of smaller id, or before it in its own. A null text is empty, texts
    shorter than LENGTH are whole. A null id precedes all others. Rows that repeat an id are
    texts of their own, ordered by a hash of the text; rows equal in id and text are one text
    and all come back as it does. All strings are judged on the input.
    """
    ship_package(docs.sparkSession)
    rows, texts = numbered(docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    runs = repeated_runs(texts.select("doc", "text")).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    joined = rows.join(runs.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "runs")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                data, ends = W.utf8(part.column(1))
                spans, kept = [], []
                for k, runs in enumerate(part.column(2)):
                    own = data[ends[k] : ends[k + 1]]
                    cut: list[dict] = []
                    if runs.is_valid:
                        lo = runs.values.field("lo").to_numpy(zero_copy_only=False).astype(np.int64)
                        hi = runs.values.field("hi").to_numpy(zero_copy_only=False).astype(np.int64)
                        # runs whose bytes touch are one removed span
                        _, lo, end = joined_runs(np.zeros(len(lo), np.int64), lo, hi + LENGTH - 1)
                        cut = [{"start": a, "end": b + 1} for a, b in zip(lo.tolist(), end.tolist())]
                    spans.append(cut)
                    if cut:
                        edges = [0, *(x for c in cut for x in (c["start"], c["end"])), len(own)]
                        kept.append(b"".join(own[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])))
                    else:
                        kept.append(own.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(ends)), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"]
                )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return joined.mapInArrow(run, schema)
