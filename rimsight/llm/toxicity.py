"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy within Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimsight.llm import words as W
from rimsight.llm.columns import fresh
from rimsight.llm.shared import held, ship_package

TASK_DOCS = 3000  # labelled rows that a task learns from in a round, about
PIECE = 512  # rows whose words a task holds at once
CELL = 0.001  # calibration counts logits in steps of this

BUCKETS = 1 << 22
PREFIXES = (4, 5, 6)
DIMS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 4
BATCH = 48
RATE = 0.05
DECAY = 1e-4
LEAST_DOCS = 3  # word features of fewer labelled documents stay at zero
PSEUDO = 3.0
CUT = 0.3  # the score at which a document counts as toxic
LEAST_LANG = 20  # toxic calibration rows a language needs for a threshold of its own
PAD = max(WIDTHS) - 1


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of each word and its prefixes (words x features), and the texts' word offsets."""
    data, offsets = W.utf8(texts)
    whole, ends, heads = W.word_hashes(data, offsets, W.PLAIN_SPLIT, PREFIXES)
    return np.stack([(h & np.uint64(BUCKETS - 1)).astype(np.int32) for h in (whole, *heads)], axis=1), ends


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Rows of the embedding by bucket, one filter bank for each width, the output layer, the calibration."""

    row_of: np.ndarray
    rows: np.ndarray
    banks: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    move: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def embed(self, features: np.ndarray) -> np.ndarray:
        index = self.row_of[features]
        x = self.rows[index[:, 0]]
        for k in range(1, index.shape[1]):
            x += self.rows[index[:, k]]
        return x

    def convolve(self, x: np.ndarray) -> list[np.ndarray]:
        """Response of every filter at every place; places past the end are zero vectors."""
        n = len(x) - PAD
        out = []
        for width, bank, shift in zip(WIDTHS, self.banks, self.shifts):
            y = x[:n] @ bank[0]
            for k in range(1, width):
                y += x[k : n + k] @ bank[k]
            out.append(y + shift)
        return out

    def pooled(self, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each text; a text without words has one empty place."""
        counts = np.diff(offsets)
        padded = np.maximum(counts, 1) + PAD
        starts = np.cumsum(padded) - padded
        x = np.zeros((int(padded.sum()) + PAD, DIMS), np.float32)
        owner, place = W.segments(counts)
        x[starts[owner] + place] = self.embed(features)
        beyond = np.ones(int(padded.sum()), bool)  # the padding would see the next text
        beyond[starts[owner] + place] = False
        beyond[starts[counts == 0]] = False
        best = []
        for y in self.convolve(x):
            y[: len(beyond)][beyond] = -np.inf
            best.append(np.maximum.reduceat(y[: len(beyond)], starts, axis=0))
        return np.maximum(np.concatenate(best, axis=1), 0)

    def logits(self, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        return self.pooled(features, offsets) @ self.out + self.bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for at in range(0, len(texts), 64):
            out.append(self.logits(*buckets(texts.slice(at, 64))))
        # rounded, since matrix products differ in the last bits with the rows around
        return np.round(sigmoid(self.slope * np.concatenate(out) + self.move), 6)


def _counted(features: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Documents of each kind that hold a bucket (2 x BUCKETS)."""
    counted = np.zeros((2, BUCKETS), np.int32)
    for own, label in zip(features, toxic):
        counted[int(label), np.unique(own)] += 1
    return counted


def _start(found: np.ndarray, n_other: np.ndarray, n_toxic: np.ndarray, prior: float, rng: np.random.Generator) -> Model:
    """Embeddings of the buckets found, which start at each one's smoothed log-odds; one filter of each width reads them."""
    odds = np.log((n_toxic + PSEUDO * prior) / (n_other + PSEUDO) / max(prior, 1e-6))
    row_of = np.zeros(BUCKETS, np.int32)
    row_of[found] = np.arange(1, len(found) + 1)
    rows = rng.normal(0, 0.02, (len(found) + 1, DIMS)).astype(np.float32)
    rows[0] = 0
    rows[1:, 0] = odds / (len(PREFIXES) + 1)
    banks = [rng.normal(0, 0.1, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
    for bank in banks:
        bank[:, 0, 0] = 1 / len(bank)
    return Model(row_of, rows, banks, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.full(len(WIDTHS) * FILTERS, 0.1, np.float32))


def _step(model: Model, docs: list[np.ndarray], target: np.ndarray, weight: np.ndarray, memory: dict) -> None:
    """One gradient step with Adagrad; only the places that win the pooling pass gradients on."""
    counts = np.array([len(d) for d in docs])
    padded = np.maximum(counts, 1) + PAD
    starts = np.cumsum(padded) - padded
    index = np.zeros((int(padded.sum()) + PAD, len(PREFIXES) + 1), np.int32)
    for s, d in zip(starts, docs):
        index[s : s + len(d)] = model.row_of[d]
    x = model.rows[index].sum(axis=1)
    best, place = [], []
    for y in model.convolve(x):
        at = np.stack([s + y[s : s + max(n, 1)].argmax(axis=0) for s, n in zip(starts, counts)])
        place.append(at)
        best.append(np.take_along_axis(y, at, axis=0))
    top = np.concatenate(best, axis=1)
    active = np.maximum(top, 0)
    error = (sigmoid(active @ model.out + model.bias) - target) * weight / len(docs)
    d_out = active.T @ error + DECAY * model.out
    d_top = np.outer(error, model.out) * (top > 0)
    moved_rows, moved_by = [], []
    for k, width in enumerate(WIDTHS):
        d = d_top[:, k * FILTERS : (k + 1) * FILTERS]
        d_bank = DECAY * model.banks[k]
        for j in range(width):
            at = place[k] + j
            d_bank[j] = d_bank[j] + np.einsum("dfe,df->ef", x[at], d)
            moved_rows.append(index[at].reshape(-1))
            moved_by.append(np.repeat((d[:, :, None] * model.banks[k][j].T[None]).reshape(-1, DIMS), len(PREFIXES) + 1, axis=0))
        _adagrad(model.banks[k], d_bank, memory.setdefault(("bank", k), np.full(d_bank.shape, 1e-3)))
        _adagrad(model.shifts[k], d.sum(axis=0), memory.setdefault(("shift", k), np.full(FILTERS, 1e-3)))
    rows, back = np.unique(np.concatenate(moved_rows), return_inverse=True)
    change = np.zeros((len(rows), DIMS), np.float64)
    np.add.at(change, back, np.concatenate(moved_by))
    past = memory.setdefault("rows", np.full(model.rows.shape, 1e-3, np.float32))
    past[rows] += change**2
    model.rows[rows] -= (RATE * change / np.sqrt(past[rows])).astype(np.float32)
    model.rows[0] = 0
    _adagrad(model.out, d_out, memory.setdefault("out", np.full(len(model.out), 1e-3)))
    model.bias -= RATE * float(error.sum())


def _adagrad(value: np.ndarray, change: np.ndarray, past: np.ndarray) -> None:
    past += change**2
    value -= (RATE * change / np.sqrt(past)).astype(value.dtype)


def best_cut(logits: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The logit that parts toxic from other rows with the best F1, in the middle of the gap there."""
    order = np.argsort(-logits, kind="stable")
    hit = np.cumsum((toxic * weight)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (toxic * weight).sum())
    k = int(np.argmax(f1))
    after = logits[order[k + 1]] if k + 1 < len(order) else logits[order[k]] - 1
    return float((logits[order[k]] + after) / 2)


def fit(texts: pa.Array, toxic: np.ndarray, langs: Sequence[str | None], prior: float, seed: int = 7) -> Model:
    """Train on four fifths of some rows in this process, calibrate on the rest; ``train`` is the form for tables.

    ``prior`` is the share of toxic rows among all labelled ones, which the rows' weights
    restore. The score's 0.3 is moved to the best cut over all languages; each language with
    enough toxic rows gets a threshold of its own, others the common one.
    """
    rng = np.random.default_rng(seed)
    toxic = np.asarray(toxic, np.float64)
    docs = []
    for at in range(0, len(texts), 64):
        features, ends = buckets(texts.slice(at, 64))
        docs += [features[a:b] for a, b in zip(ends[:-1], ends[1:])]
    share = toxic.mean() if len(toxic) else 0.0
    weight = np.where(toxic == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    turn = rng.permutation(len(docs))
    tuned, trained = turn[: len(turn) // 5], turn[len(turn) // 5 :]
    odds = prior / max(1 - prior, 1e-6)
    sample_odds = toxic[trained].sum() / max((1 - toxic[trained]).sum(), 1)
    counted = _counted([docs[i] for i in trained], toxic[trained])
    found = np.flatnonzero(counted.sum(axis=0) >= LEAST_DOCS)
    model = _start(found, *counted[:, found].astype(np.float64), max(sample_odds, 1e-6), rng)
    model.bias = float(np.log(max(odds, 1e-6)))
    if not toxic.any() or toxic.all():
        model.out[:] = 0
        return model
    memory: dict = {}
    # toxic rows weigh as much as the others while filters form; the calibration undoes it
    even = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
    steps = max(EPOCHS, -(-30 * BATCH // max(len(trained), 1)))
    for _ in range(min(steps, 40)):
        order = rng.permutation(trained)
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            _step(model, [docs[i] for i in some], toxic[some], even[some], memory)
    chosen = tuned if toxic[tuned].sum() >= 5 else turn
    logits = np.concatenate([model.logits(*_joined([docs[i] for i in chosen[at : at + 64]])) for at in range(0, len(chosen), 64)])
    cut = best_cut(logits, toxic[chosen], weight[chosen])
    model.slope = 1.0
    model.move = float(np.log(CUT / (1 - CUT)) - model.slope * cut)
    named = np.array([x or "" for x in langs])[chosen]
    for lang in np.unique(named):
        own = named == lang
        if toxic[chosen][own].sum() >= LEAST_LANG:
            cut = best_cut(logits[own], toxic[chosen][own], weight[chosen][own])
            model.thresholds[str(lang)] = float(sigmoid(np.array(model.slope * cut + model.move)))
    return model


def _joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(d) for d in docs], out=ends[1:])
    return np.concatenate(docs), ends


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Pieces of batches whose first column is the text, with the features of each row's words."""
    for batch in batches:
        for at in range(0, len(batch), PIECE):
            piece = batch.slice(at, PIECE)
            features, ends = buckets(piece.column(0))
            yield piece, [features[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _dense(model: Model) -> np.ndarray:
    """All weights but the embeddings, in rows as wide as those."""
    flat = np.concatenate([x.ravel().astype(float) for x in (*model.banks, *model.shifts, model.out)] + [[model.bias]])
    return np.pad(flat, (0, -len(flat) % DIMS)).reshape(-1, DIMS)


def _moved(model: Model, dense: np.ndarray) -> None:
    """Adds changes of the form of ``_dense`` to the model."""
    at, flat = 0, dense.ravel()
    for x in (*model.banks, *model.shifts, model.out):
        x += flat[at : at + x.size].reshape(x.shape).astype(x.dtype)
        at += x.size
    model.bias += float(flat[at])


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted = np.zeros((2, BUCKETS), np.int32)
    for piece, docs in _pieces(batches):
        for own, label in zip(docs, piece.column(1).to_pylist()):
            counted[label, np.unique(own)] += 1
    some_of = np.flatnonzero(counted.any(axis=0))
    for at in range(0, len(some_of), 1 << 16):
        some = some_of[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *[pa.array(c[some], pa.int64()) for c in counted]], ["bucket", "other", "toxic"])


def _learn(rows: DataFrame, model: Model, share: float, turn: int) -> None:
    """One round: every task takes gradient steps through its rows from the same model; the changes are averaged.

    A task's changes weigh by its rows, an embedding's are averaged over the tasks that moved it.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"d{i}" for i in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        own = Model(base.row_of, base.rows.copy(), [x.copy() for x in base.banks], [x.copy() for x in base.shifts], base.out.copy(), base.bias)
        memory: dict = {}
        rng, seen = np.random.default_rng(turn), 0
        for piece, docs in _pieces(batches):
            toxic = piece.column(1).to_numpy().astype(np.float64)
            even = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                _step(own, [docs[i] for i in some], toxic[some], even[some], memory)
            seen += len(docs)
        if not seen:
            return
        touched = np.flatnonzero((own.rows != base.rows).any(axis=1))
        dense = _dense(own) - _dense(base)
        at = np.concatenate([-1 - np.arange(len(dense)), touched])
        change = np.concatenate([dense, own.rows[touched].astype(float) - base.rows[touched]])
        for k in range(0, len(at), 1 << 16):
            part = slice(k, k + (1 << 16))
            columns = [pa.array(at[part], pa.int64()), pa.array(np.full(len(at[part]), float(seen))), *[pa.array(change[part, i]) for i in range(DIMS)]]
            yield pa.RecordBatch.from_arrays(columns, ["at", "n", *names])

    made = rows.mapInArrow(run, "at long, n double, " + ", ".join(f"{x} double" for x in names))
    mean = made.groupBy("at").agg(*[(F.sum(F.col(x) * F.col("n")) / F.sum("n")).alias(x) for x in names])
    whole = mean.toArrow()
    shared.destroy()
    at = whole.column("at").to_numpy()
    change = np.stack([whole.column(x).to_numpy() for x in names], axis=1)
    dense = np.zeros_like(_dense(model))
    dense[-1 - at[at < 0]] = change[at < 0]
    _moved(model, dense)
    model.rows[at[at >= 0]] += change[at >= 0].astype(np.float32)


def _calibrate(rows: DataFrame, model: Model) -> None:
    """Moves the score's 0.3 to the best cut over all rows given; languages with enough toxic rows get their own."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, docs in _pieces(batches):
            found = np.concatenate([shared.value.logits(*_joined(docs[at : at + 64])) for at in range(0, len(docs), 64)])
            cells = pa.array(np.round(found / CELL).astype(np.int64))
            yield pa.RecordBatch.from_arrays([piece.column(2), piece.column(1), cells], ["lang", "toxic", "cell"])

    cells = rows.mapInArrow(run, "lang string, toxic int, cell long").groupBy("lang", "cell", "toxic").agg(F.count(F.lit(1)).alias("n"))
    # a row a language, step and kind, whatever the rows
    whole = cells.toArrow().sort_by([("lang", "ascending"), ("cell", "ascending"), ("toxic", "descending")])
    shared.destroy()
    logits, toxic, n = whole.column("cell").to_numpy() * CELL, whole.column("toxic").to_numpy().astype(float), whole.column("n").to_numpy().astype(float)
    cut = best_cut(logits, toxic, n)
    model.move = float(np.log(CUT / (1 - CUT)) - model.slope * cut)
    named = np.array([x or "" for x in whole.column("lang").to_pylist()])
    for lang in np.unique(named):
        own = named == lang
        if (toxic * n)[own].sum() >= LEAST_LANG:
            cut = best_cut(logits[own], toxic[own], n[own])
            model.thresholds[str(lang)] = float(sigmoid(np.array(model.slope * cut + model.move)))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled documents that are not held out: four fifths teach, the rest calibrate.

    Reads doc_id, text, lang of ``docs`` (lang for thresholds only) and doc_id, toxic of
    ``labels``. Labels that are null or without a document count for nothing; of several for
    one document the larger counts. Word counts, rounds of learning and calibration are Spark
    jobs over all those rows; what comes back is bounded by the hash buckets. Without rows of
    both kinds every score is the prior.
    """
    ship_package(docs.sparkSession)
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    wanted = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), lang.alias("lang"))
    tuned = F.pmod(F.xxhash64("doc_id", "text"), F.lit(5)) == 0
    # texts are dealt by id at every size, those held out stay behind
    found = wanted.filter(~held_out(F.col("doc_id"))).join(known.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "toxic", "lang", tuned.alias("tuned"))
    rows = held(found.sortWithinPartitions("doc_id", "text").drop("doc_id"), "labelled")
    sizes = {(r["tuned"], r["toxic"]): r["count"] for r in rows.groupBy("tuned", "toxic").count().collect()}
    n_toxic, n_other = (sum(n for (_, kind), n in sizes.items() if kind == want) for want in (1, 0))
    prior = n_toxic / max(n_toxic + n_other, 1)
    # with hardly any rows kept apart, all calibrate; with none to learn from, all teach
    taught = rows.filter(~F.col("tuned")) if min(sizes.get((False, 1), 0), sizes.get((False, 0), 0)) else rows
    chosen = rows.filter("tuned") if sizes.get((True, 1), 0) >= 5 else rows
    learned = sizes.get((False, 0), 0) + sizes.get((False, 1), 0)
    taught = taught.select("text", "toxic").coalesce(max(1, learned // TASK_DOCS))
    counts = taught.mapInArrow(_count_task, "bucket long, other long, toxic long").groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    counts = counts.filter(F.col("other") + F.col("toxic") >= LEAST_DOCS).toArrow().sort_by("bucket")
    odds = max(sizes.get((False, 1), 0) / max(sizes.get((False, 0), 0), 1), 1e-6)
    rng = np.random.default_rng(7)
    model = _start(counts.column("bucket").to_numpy(), counts.column("other").to_numpy().astype(float), counts.column("toxic").to_numpy().astype(float), odds, rng)
    model.bias = float(np.log(max(prior / max(1 - prior, 1e-6), 1e-6)))
    if not n_toxic or not n_other:
        model.out[:] = 0
        return model
    share = sizes.get((False, 1), 0) / max(learned, 1)
    share = share if 0 < share < 1 else prior
    for turn in range(min(max(EPOCHS, -(-30 * BATCH // max(learned, 1))), 40)):
        _learn(taught, model, share, turn)
    _calibrate(chosen.select("text", "toxic", "lang"), model)
    return model


def with_scores(docs: DataFrame, model: Model, keep: Sequence[str] | None = None, score: str = "score") -> DataFrame:
    """Columns of ``docs`` (or those to keep) and the score of the whole text; null text is empty."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = list(docs.columns if keep is None else keep)
    (text,) = fresh(docs.select(*kept), "scored_text")
    rows = docs.select(*kept, F.col("text").cast("string").alias(text))
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k) for k in range(len(kept))]
            found = pa.array(shared.value.scores(batch.column(len(kept))), pa.float64())
            yield pa.RecordBatch.from_arrays([*columns, found], [*kept, score])

    return rows.mapInArrow(run, schema)


def threshold(model: Model, lang: Column) -> Column:
    """The language's calibrated threshold, or the common one."""
    if not model.thresholds:
        return F.lit(CUT)
    pairs = [F.lit(x) for item in sorted(model.thresholds.items()) for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce(lang, F.lit(""))), F.lit(CUT))
