"""Quality: gradient-boosted trees over histograms of document statistics, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimsight.llm import words as W
from rimsight.llm.columns import fresh
from rimsight.llm.shared import ship_package

# The only bounded sample: labelled rows that the trees are fitted on.
TRAIN_ROWS = 20_000

BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
RIDGE = 1.0
LEAST_WEIGHT = 2.0  # sum of second derivatives a child needs
CUT = 0.5
SLICE_ROWS = 256
SLICE_BYTES = 4 << 20

# Byte kinds that are counted, in the order of KINDS.
KINDS = ["lower", "upper", "digit", "blank", "newline", "space", "stop", "comma", "shout", "ask", "quote", "bracket", "symbol", "joint", "control", "lead", "trail"]
SHARES = ["ends", "symbol_ends", "same"]
WORDS = ["words", "word_mean", "word_spread", "long_words", "new_words", "top_word", "new_pairs", "new_fours"]
LINES = ["lines", "line_mean", "new_lines"]
FEATURES = ["bytes", *KINDS, *SHARES, *WORDS, *LINES]


def _kinds() -> np.ndarray:
    kind = {name: k for k, name in enumerate(KINDS)}
    out = np.full(256, kind["control"], np.int64)
    for name, members in (
        ("digit", "0123456789"), ("blank", " "), ("newline", "\n"), ("space", "\t\r\x0b\x0c"), ("stop", "."), ("comma", ",;:"),
        ("shout", "!"), ("ask", "?"), ("quote", "\"'`-"), ("bracket", "()[]{}<>"), ("symbol", "#$%&*@^~|"), ("joint", "/\\_=+"),
    ):
        out[[ord(c) for c in members]] = kind[name]
    out[97:123], out[65:91], out[0xC0:], out[0x80:0xC0] = kind["lower"], kind["upper"], kind["lead"], kind["trail"]
    return out


_KIND = _kinds()
_END = np.isin(np.arange(256), [ord(c) for c in ".!?,;:"])
_SYMBOL = _KIND == KINDS.index("symbol")
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LINE_SPLIT = W._table(b"\n")
_LINE_SPLIT[0] = 65  # NUL is part of a line


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different values of each owner, and the count of its most frequent one."""
    keys = W.mix(hashes + W.mix(owner.astype(np.uint64) + np.uint64(1)))
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner[first], counts)
    return np.bincount(owner[first], minlength=n), most


def statistics(texts: pa.Array) -> np.ndarray:
    """FEATURES of each whole text (texts x features); null is empty, and an empty text is all zeros."""
    data, offsets = W.utf8(texts)
    n, size = len(texts), np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    safe = np.maximum(size, 1).astype(float)
    kinds = np.bincount(owner * len(KINDS) + _KIND[data], minlength=n * len(KINDS)).reshape(n, len(KINDS)) / safe[:, None]
    same_text = owner[1:] == owner[:-1]
    before, after = data[:-1], data[1:]
    ends = _END[before] & _BLANK[after] & same_text
    symbol_ends = _SYMBOL[before] & _BLANK[after] & same_text
    same = (before == after) & same_text
    per = lambda mask: np.bincount(owner[:-1][mask], minlength=n) if len(owner) else np.zeros(n)
    hashes, cuts, _ = W.word_hashes(data, offsets, W.BLANK_SPLIT)
    count = np.diff(cuts)
    some = np.maximum(count, 1).astype(float)
    of_word = np.repeat(np.arange(n), count)
    inside = ~_BLANK[data]
    starts, stops = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | ~same_text
    stops[:-1] &= ~inside[1:] | ~same_text
    length = (np.flatnonzero(stops) - np.flatnonzero(starts) + 1).astype(float)
    mean = np.bincount(of_word, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(of_word, length**2, n) / some - mean**2, 0))
    distinct, most = _distinct(hashes, of_word, n)
    new = [distinct / some]
    for k in (2, 4):
        whole = np.arange(len(hashes)) + k <= np.repeat(cuts[1:], count)
        grams, of_gram = W.grams(hashes, k)[whole], of_word[whole]
        new.append(_distinct(grams, of_gram, n)[0] / np.maximum(np.bincount(of_gram, minlength=n), 1))
    line_hashes, line_cuts, _ = W.word_hashes(data, offsets, _LINE_SPLIT)
    lines = np.diff(line_cuts)
    new_lines = _distinct(line_hashes, np.repeat(np.arange(n), lines), n)[0] / np.maximum(lines, 1)
    columns = [
        size, *kinds.T, per(ends) / some, per(symbol_ends) / some, per(same) / safe, count, mean, spread,
        np.bincount(of_word[length > 20], minlength=n) / some, new[0], most / some, new[1], new[2], lines, size / np.maximum(lines, 1), new_lines,
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1)


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of bounded rows and bytes (a longer text is a run of its own), with their places."""
    sizes = np.cumsum(np.diff(W.utf8(texts)[1]))
    at = 0
    while at < len(texts):
        base = int(sizes[at - 1]) if at else 0
        end = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(sizes, base + SLICE_BYTES, "right"))))
        yield at, texts.slice(at, end - at)
        at = end


@dataclass
class Trees:
    """A forest as arrays (trees x nodes): a node's children are 2 k + 1 and 2 k + 2, leaves have no feature."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    bias: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        """All rows walk all trees at once, a level a step."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            f = self.feature[trees, at]
            right = x[rows, np.maximum(f, 0)] > self.threshold[trees, at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return self.bias + self.value[trees, at].sum(axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for _, part in slices(texts):
            out.append(1 / (1 + np.exp(-np.clip(self.logits(statistics(part)), -40, 40))))
        return np.round(np.concatenate(out), 6)


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """Cuts of each feature between at most BINS bins of about equal size; a value up to a cut lies before it."""
    return [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) if len(column) else np.zeros(0) for column in x.T]


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees of logistic loss level by level; each split is the best over histograms of binned features.

    Without rows the score is one half, with rows of one kind it is that kind's smoothed share.
    """
    n, nodes = len(y), 2 ** (DEPTH + 1) - 1
    share = (y.sum() + 1) / (n + 2)
    bias = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Trees(np.full((0, nodes), -1), np.zeros((0, nodes)), np.zeros((0, nodes)), bias)
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    m = x.shape[1]
    cell = binned + np.arange(m) * BINS
    usable = np.arange(BINS)[None, :] < np.array([len(e) for e in edges])[:, None]  # a cut after each bin
    logit = np.full(n, bias)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        at = np.zeros(n, np.int64)
        value[0] = gradient.sum() / (weight.sum() + RIDGE)
        live = [0]
        for level in range(DEPTH):
            base = 2**level - 1
            place = (at - base)[:, None] * (m * BINS) + cell
            here = at >= base
            flat, size = place[here].ravel(), 2**level * m * BINS
            g = np.bincount(flat, np.repeat(gradient[here], m), size).reshape(-1, m, BINS).cumsum(axis=2)
            h = np.bincount(flat, np.repeat(weight[here], m), size).reshape(-1, m, BINS).cumsum(axis=2)
            grown = []
            for node in live:
                gl, hl = g[node - base], h[node - base]
                gt, ht = gl[0, -1], hl[0, -1]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[~usable | (hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = -1
                best = int(gain.argmax())
                f, b = divmod(best, BINS)
                if gain[f, b] <= 1e-9:
                    continue
                feature[node], threshold[node] = f, edges[f][b]
                for child, cg, ch in ((2 * node + 1, gl[f, b], hl[f, b]), (2 * node + 2, gt - gl[f, b], ht - hl[f, b])):
                    value[child] = cg / (ch + RIDGE)
                    grown.append(child)
                own = at == node
                at[own] = 2 * node + 1 + (x[own, f] > threshold[node])
            live = grown
        values.append(value * RATE)
        features.append(feature)
        thresholds.append(threshold)
        logit += values[-1][at]
    return Trees(np.stack(features), np.stack(thresholds), np.stack(values), bias)


def _mapped(docs: DataFrame, keep: Sequence[str], out: str, kind: T.DataType, compute) -> DataFrame:
    """Columns to keep, and ``compute`` of the text under the name ``out`` (which no kept column may have)."""
    ship_package(docs.sparkSession)
    (text,) = fresh(docs.select(*keep), "whole_text")
    rows = docs.select(*keep, F.col("text").cast("string").alias(text))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(len(keep))):
                own = [batch.column(k).slice(at, len(part)) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, compute(part)], [*keep, out])

    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame) -> Trees:
    """Fit on at most TRAIN_ROWS labelled documents, none of them held out.

    Reads doc_id and text of ``docs`` and doc_id and quality of ``labels``. Labels other than
    0 and 1, or without a document, count for nothing; of several for one document the larger
    counts. The statistics are computed in tasks, only they come to the driver.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    wanted = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    compute = lambda part: pa.array(list(statistics(part)), pa.list_(pa.float64()))
    found = _mapped(wanted, ["doc_id", "quality"], "statistics", T.ArrayType(T.DoubleType()), compute)
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", "statistics").limit(TRAIN_ROWS).toArrow().combine_chunks()
    x = np.array(rows.column("statistics").to_pylist(), float).reshape(rows.num_rows, len(FEATURES))
    return fit(x, rows.column("quality").to_numpy().astype(float))


def with_scores(docs: DataFrame, model: Trees, keep: Sequence[str] | None = None, score: str = "score") -> DataFrame:
    """Columns of ``docs`` (or those to keep) and the score of the whole text.

    Null and empty texts have a score as any other; repeated rows are scored each; a column of
    ``docs`` with the score's name stays, and the score then takes that name with underscores
    before it. An empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = list(docs.columns if keep is None else keep)
    (name,) = fresh(docs.select(*kept), score)
    return _mapped(docs, kept, name, T.DoubleType(), lambda part: pa.array(shared.value.scores(part), pa.float64()))
