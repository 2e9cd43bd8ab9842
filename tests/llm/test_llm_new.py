"""Quality, repair and ranked search against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rimsight.llm import quality, ranked_search, repair
from rimsight.llm.queries_repair import damaged

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


# quality


def test_statistics_do_not_depend_on_neighbours():
    texts = ["One two two.\nOne two two.\nx", "", None, "ABC!! DEF%%% ghé", "\n\n", "word " * 5000]
    whole = quality.statistics(pa.array(texts, pa.string()))
    assert whole.shape == (6, len(quality.FEATURES)) and np.isfinite(whole).all()
    for k, text in enumerate(texts):
        np.testing.assert_allclose(quality.statistics(pa.array([text], pa.string()))[0], whole[k])
    named = dict(zip(quality.FEATURES, whole[0]))
    assert (named["words"], named["lines"]) == (7, 3)
    assert named["new_words"] == pytest.approx(4 / 7) and named["top_word"] == pytest.approx(2 / 7)  # "two" and "two." differ
    assert named["new_lines"] == pytest.approx(2 / 3)
    assert named["ends"] == pytest.approx(2 / 7)
    assert dict(zip(quality.FEATURES, whole[3]))["symbol_ends"] == pytest.approx(1 / 3)
    assert not whole[1].any() and not whole[2].any()


def _walk(trees: quality.Trees, row: np.ndarray) -> float:
    total = trees.bias
    for f, t, v in zip(trees.feature, trees.threshold, trees.value):
        at = 0
        while f[at] >= 0:
            at = 2 * at + 1 + int(row[f[at]] > t[at])
        total += v[at]
    return total


def test_trees_learn_and_walk_alike():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 6)).round(2)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0.1)).astype(float)
    trees = quality.fit(x[:2000], y[:2000])
    found = trees.logits(x[2000:])
    np.testing.assert_allclose(found[:50], [_walk(trees, r) for r in x[2000:2050]])
    assert ((found > 0) == (y[2000:] == 1)).mean() > 0.93


def test_trees_without_rows_or_kinds():
    x = np.zeros((4, len(quality.FEATURES)))
    assert quality.fit(x[:0], np.zeros(0)).logits(x).tolist() == [0, 0, 0, 0]
    assert (quality.fit(x, np.ones(4)).logits(x) > 0).all()


def test_quality_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(i * 3, i % 2, 0) for i in range(12)] + [(0, 1, 0), (3, None, 0), (None, 1, 0), (999, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(awkward, labels)
    rows = quality.with_scores(awkward, model).collect()
    assert len(rows) == awkward.count() and rows[0].__fields__ == [*awkward.columns, "_score"]
    assert all(0 <= r["_score"] <= 1 for r in rows)
    alone = {r["doc_id"]: r["_score"] for r in quality.with_scores(awkward.repartition(7), model, ["doc_id", "text"], score="_score").collect()}
    assert all(alone[r["doc_id"]] == r["_score"] for r in rows)
    assert quality.with_scores(no_docs, quality.train(no_docs, labels)).collect() == []
    assert 0 < quality.with_scores(awkward, quality.train(awkward, labels.limit(0)), ["doc_id"]).first()["score"] < 1


def test_quality_holds_out_labels(spark):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice(["the", "house", "of", "river", "stands"]) for _ in range(rng.randint(20, 60))) + "."
    bad = lambda: " ".join(rng.choice(["buy", "now"]).upper() + "!!" for _ in range(rng.randint(20, 60)))
    rows = [(i, bad() if i % 5 == 0 else good()) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(400)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality.with_scores(docs, quality.train(docs, x), ["doc_id"]).orderBy("doc_id").collect() for x in (labels, flipped))
    assert one == two
    assert all((r["score"] >= quality.CUT) == (r["doc_id"] % 5 != 0) for r in one)


# repair


def _best(rows: list[tuple[str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cheapest audit by trying all scripts of bounded insertions, for short conversations."""
    seen, kinds = set(), []
    for role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        must = not stripped or (role, text) in seen
        seen.add((role, text))
        kinds.append((must, not must and stripped[-1] not in ".!?"))
    found = []

    def go(k, cost, audit, out, inserted):
        if cost > 3 * len(rows) or len(audit) > 2 * len(rows) + 2:
            return
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
            found.append((cost, audit, out))
        expect = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if inserted < 2:
            go(k, cost + 2, audit + "I", [*out, (expect, "")], inserted + 1)
        if k < len(rows):
            (role, text), (must, cut) = rows[k], kinds[k]
            go(k + 1, cost + 3, audit + "D", out, 0)
            if not must:
                if re.fullmatch("s?(ua)*u?", "".join(r[:1] for r, _ in [*out, (role, text)])) and role:
                    go(k + 1, cost + cut, audit + "K", [*out, (role, text)], 0)
                go(k + 1, cost + 2 + cut, audit + "R", [*out, (expect, text)], 0)

    go(0, 0, "", [], 0)
    return min(found, key=lambda x: x[:2])


def _sequences():
    rng = random.Random(11)
    texts = ["Hello.", "cut off", "", " \n", "Same?", "Same?", "well!"]
    for n in range(5):
        for _ in range(14):
            yield [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), rng.choice(texts)) for _ in range(n)]


def _digest(out):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


@pytest.mark.parametrize("size", [1, 2, 128])
def test_repair_against_all_scripts(spark, size):
    """Blocks of one, two and many rows give the same as trying every script."""
    cases = list(_sequences())
    rows = [(c, t, role, text) for c, case in enumerate(cases) for t, (role, text) in enumerate(case)]
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r["conv_id"]: r for r in repair.reports(made, block_rows=size).collect()}
    for c, case in enumerate(cases):
        if case:
            cost, audit, out = _best(case)
            assert (got[c]["cost"], got[c]["audit"], got[c]["repaired_sha256"]) == (cost, audit, _digest(out)), case
    assert len(got) == sum(1 for c in cases if c)


def test_long_conversation_in_blocks(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"text {t}.", "again", "", f"open {t}"])) for t in range(3000)]
    rows += [(1, 7, "user", "hot")] * 500 + [(2, 0, "system", "Only.")]
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one, two = ({r["conv_id"]: r for r in repair.reports(made.repartition(n), block_rows=b).collect()} for n, b in ((3, 128), (8, 37)))
    assert one == two
    assert one[1]["audit"].count("D") >= 499 and one[1]["gaps"] == 0
    kept = repair.repaired(made, block_rows=64).where("conv_id = 1").orderBy("n").collect()
    assert [r["n"] for r in kept] == list(range(len(kept)))
    assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept))
    assert _digest([(r["role"], r["text"]) for r in kept]) == one[1]["repaired_sha256"]
    assert (one[2]["cost"], one[2]["audit"]) == (3, "D")


def test_repair_of_awkward_rows(spark):
    schema = "conv_id long, turn long, role string, text string, cost string, audit long, mark int"
    rows = [
        (None, 1, "user", "Null conversation."), (None, 2, "assistant", "Yes."), (5, None, None, None), (5, None, "user", "No turn."), (5, 3, "assistant", "Three."),
        (5, 9, "user", "x" * 50_000), (6, 1, "user", "Tie b."), (6, 1, "assistant", "Tie a."), (7, 1, "user", "Same."), (7, 1, "user", "Same."), (8, 4, "user", ""),
    ]
    made = spark.createDataFrame([(*r, "c", 1, 2) for r in rows], schema).repartition(3)
    got = {r["conv_id"]: r.asDict() for r in repair.reports(made).collect()}
    assert set(got) == {None, 5, 6, 7, 8}
    assert (got[None]["audit"], got[None]["cost"], got[None]["gaps"]) == ("KK", 0, 0)
    assert (got[5]["blank"], got[5]["truncated"], got[5]["gaps"], got[5]["illegal"]) == (1, 1, 5, 1)
    assert got[6]["audit"] == "DKI" or got[6]["cost"] == 4  # assistant before user in one turn
    assert (got[7]["duplicate"], got[7]["illegal"], got[7]["audit"]) == (1, 1, "KDI")
    assert (got[8]["audit"], got[8]["repaired_sha256"]) == ("D", hashlib.sha256(b"").hexdigest())
    assert repair.reports(made.limit(0)).collect() == [] and repair.repaired(made.limit(0)).collect() == []
    assert damaged(made).columns == ["conv_id", "turn", "role", "text"]


def test_joined_runs_equal_one_run():
    rng = random.Random(4)
    for _ in range(60):
        steps = [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(2, 9))]
        cut = rng.randint(1, len(steps) - 1)
        width, whole = repair.weights(steps)
        both, parts = repair.joined(*repair.weights(steps[:cut]), *repair.weights(steps[cut:]))
        for a, b in zip(whole, parts):
            assert (a is None) == (b is None)
            if a is not None:
                assert (a >> repair.BITS * width, repair.letters(a, width)) == (b >> repair.BITS * both, repair.letters(b, both))


# ranked search


def _ranked(docs, items):
    words = [(i, TERM.findall(low(t))) for i, t in docs]
    filled = [(i, w) for i, w in words if w]
    n, total = len(filled), sum(len(w) for _, w in filled)
    df: dict[str, int] = {}
    for _, w in filled:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, []).extend(TERM.findall(low(text)))
    out = []
    for item, terms in wanted.items():
        found = []
        for i, w in filled:
            m = 100 - 75 + (75 * len(w) * n) // total
            score = 0
            for t in terms:
                if tf := w.count(t):
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, -math.inf if i is None else i, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: x[:2])[:10])]
    return sorted(out, key=repr)


def _made_docs():
    rng = random.Random(8)
    common, rare = ["the", "of", "Und", "été"], [f"w{k}" for k in range(60)]
    docs = [(i, " ".join(rng.choice(common if rng.random() < 0.7 else rare) for _ in range(rng.randint(0, 60)))) for i in range(700)]
    docs += [(900 + i, "the w1 w2") for i in range(30)]  # ties
    return docs + [(None, "w1 w1 w2 w3"), (5, "w5 w5, w6"), (5, "w5 w5, w6"), (2000, None), (2001, ""), (2002, "w7 " * 9000), (2003, "-- !?")]


def test_ranked_against_plain_python(spark, monkeypatch):
    docs = _made_docs()
    items = [(k, f"The w{k} of w{k + 1} und w{k} ÉTÉ été") for k in range(25)] + [(100, None), (101, "!!"), (102, "unknown"), (None, "w1 w2 the"), (103, "w5"), (103, "w6"), (104, "the")]
    made = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, rank int").repartition(4)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    want = _ranked(docs, items)
    assert sorted(map(tuple, ranked_search.ranked(made, asked).collect()), key=repr) == want
    monkeypatch.setattr(ranked_search, "QUERY_TERMS", 30)  # several blocks of items
    assert sorted(map(tuple, ranked_search.ranked(made, asked).collect()), key=repr) == want
    assert ranked_search.ranked(made.limit(0), asked).collect() == [] and ranked_search.ranked(made, asked.limit(0)).collect() == []


def test_shards_prune_and_stay_exact(monkeypatch):
    """Small steps and shards: lists become non-essential, blocks are rejected unread, results stay."""
    monkeypatch.setattr(ranked_search, "STEP_DOCS", 64)
    rng = np.random.default_rng(1)
    n_docs, n_terms = 3000, 12
    chance = np.linspace(0.9, 0.02, n_terms)
    held_ = rng.random((n_docs, n_terms)) < chance
    counts = np.where(held_, rng.integers(1, 30, (n_docs, n_terms)), 0)
    n = counts.sum(axis=1) + rng.integers(1, 50, n_docs)
    q = ranked_search.Queries(np.arange(n_terms, dtype=np.uint64), np.array([0, n_terms]), np.arange(n_terms), np.ones(n_terms, np.int64), n=n_docs, total=int(n.sum()))
    q.weight = np.array([int(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in held_.sum(axis=0)])
    doc, term = np.nonzero(held_)
    shard = ranked_search.Shard(np.arange(n_docs)[::-1] * 2, n, np.concatenate([[0], np.cumsum(held_.sum(axis=1))]), term, counts[doc, term], q)
    reads = []
    whole = ranked_search.Shard.postings
    monkeypatch.setattr(ranked_search.Shard, "postings", lambda self, blocks: reads.append(len(blocks)) or whole(self, blocks))
    heap = ranked_search.search(shard, q.term, q.weight, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    m = 25 + (75 * n * n_docs) // int(n.sum())
    score = (q.weight * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[:, None]))).sum(axis=1)
    ids = np.arange(n_docs)[::-1] * 2
    best = np.lexsort((ids, -score))[:10]
    assert heap[0].tolist() == score[best].tolist() and heap[1].tolist() == ids[best].tolist()
    again = []
    monkeypatch.setattr(ranked_search, "STEP_DOCS", 4096)
    monkeypatch.setattr(ranked_search.Shard, "postings", lambda self, blocks: again.append(len(blocks)) or whole(self, blocks))
    ranked_search.search(shard, q.term, q.weight, heap)
    assert sum(again) < 0.8 * int(shard.first[-1])  # a warm threshold reads fewer blocks than there are


def test_packed_blocks_round_trip():
    rng = np.random.default_rng(2)
    values = np.stack([rng.integers(0, 2**w if w else 1, ranked_search.BLOCK) for w in itertools.islice(itertools.cycle([0, 1, 3, 7, 17]), 40)])
    packed = ranked_search.Packed(values)
    some = np.array([3, 7, 7, 39, 0])
    assert (packed.read(some) == values[some]).all()
