"""Mixing, search, toxicity and the pipeline."""

import random
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rimsight.llm import mixing, near_join, top_products, toxicity


def filled(sizes: dict, share=1.5, most=2) -> dict:
    """Targets by pouring in rounds until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, rest, left = {}, list(names), share * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * left / total >= most * sizes[s]]
        if not over:
            return target | {s: weight[s] * left / total for s in rest}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            rest.remove(s)
        if not rest:
            return target


def test_mixing_awkward(spark, awkward, no_docs):
    rows = [r.asDict() for r in mixing.taken_copies(awkward).collect()]
    assert len(rows) == awkward.count()
    again = [r.asDict() for r in mixing.taken_copies(awkward.repartition(7)).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, again))
    sizes = defaultdict(int)
    for r in awkward.collect():
        sizes[r["source"]] += len(brute.BLANK.findall(r["text"] or ""))
    want = filled(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    made = mixing.mix(awkward)
    assert made.columns == awkward.columns
    assert made.count() == sum(r["copies"] for r in rows)
    assert mixing.taken_copies(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []


def test_mixing_hot_source(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") * 7919 % 97).cast("int")).alias("text"),
    )
    sums = mixing.taken_copies(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("t"), F.max("target").alias("g"))
    assert all(abs(r["t"] - r["g"]) <= 97 for r in sums.collect())


def products(rows, every=100, top=10):
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in kept:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q)[:top]
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("scale", [0.05, 1.0, 1e5])
def test_top_products(spark, scale):
    rng = np.random.default_rng(int(scale * 100))
    rows = [(i, (rng.normal(0, scale, 12) * rng.choice([0.1, 1, 5])).tolist()) for i in range(700)]
    rows += [(1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] * 12), (None, [1.0] * 12), (1100, [0.0] * 12), (1101, [scale] * 5), (1200, [])]
    rows += [(2000 + i, rows[5][1]) for i in range(30)]  # ties
    vectors = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, vector string, length double").repartition(5)
    assert sorted(map(tuple, top_products.top_products(vectors).collect())) == products(rows)


def test_top_products_empty_and_few(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_products.top_products(none).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_products.top_products(few).collect()] == [(0, 1, 1, 1024 * 2048)]


def test_search_prunes_without_loss():
    rng = np.random.default_rng(9)
    rows = np.floor(rng.normal(0, 300, (4000, 16)) * np.linspace(3, 0.1, 16) * rng.choice([0.1, 1, 4], (4000, 1)))
    lengths = np.linalg.norm(rows, axis=1)
    order = np.argsort(-lengths)
    turn = np.linalg.svd(rows.T @ rows)[0]
    search = top_products.Search(np.arange(-20, 0), rows[:20], turn, 4, 10)
    for at in range(0, 4000, 256):
        k = order[at : at + 256]
        if not search.add(k, rows[k], lengths[k]):
            break
    exact = (rows[:20] @ rows.T).astype(np.int64)
    for q in range(20):
        assert [v for _, v in search.found[q]] == np.lexsort((np.arange(4000), -exact[q]))[:10].tolist()
    assert search.compared < 0.5 * 20 * 4000


def sample(n, seed, toxic=("scumlord", "vileness")):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 120))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(toxic) + rng.choice(["", "s", "ly"])
        out.append((" ".join(words), int(bad)))
    return out


def test_toxicity_held_out_accuracy():
    train, test = sample(700, 1), sample(300, 2)
    model = toxicity.fit(pa.array([t for t, _ in train]), np.array([y for _, y in train]), ["en"] * 700, 0.2)
    got = model.scores(pa.array([t for t, _ in test])) >= toxicity.CUT
    want = np.array([y for _, y in test]) == 1
    assert (got == want).mean() > 0.97
    assert set(model.thresholds) <= {"en"}


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    rows = sample(900, 3)
    docs = spark.createDataFrame([(i, t, "en") for i, (t, _) in enumerate(rows)], "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, int(y)) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "TASK_DOCS", 150)  # several tasks, whose changes are averaged
    monkeypatch.setattr(toxicity, "TRAIN_TOXIC", 1, raising=False)
    monkeypatch.setattr(toxicity, "TRAIN_OTHER", 1, raising=False)
    scored = toxicity.with_scores(docs, toxicity.train(docs, labels), ["doc_id"])
    got = scored.filter(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(got) > 150
    assert sum((r["score"] >= toxicity.CUT) == (rows[r["doc_id"]][1] == 1) for r in got) / len(got) > 0.97


def test_toxicity_awkward(spark, awkward, no_docs):
    labels = spark.createDataFrame([(i * 3, i % 2, None) for i in range(19)] + [(None, 1, None), (3, None, None), (999, 1, None)], "doc_id long, toxic int, quality int")
    model = toxicity.train(awkward, labels)
    scored = toxicity.with_scores(awkward.drop("score"), model)
    rows = scored.collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = defaultdict(set)
    for r in rows:
        by_text[(r["text"] or "").lower()].add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())  # nothing but the words decides
    # labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.with_scores(awkward.drop("score"), toxicity.train(awkward, flipped)).collect()
    assert sorted(r["score"] for r in other) == sorted(r["score"] for r in rows)
    blank = toxicity.train(no_docs, labels.limit(0))
    assert all(r["score"] == pytest.approx(r["score"]) for r in toxicity.with_scores(awkward, blank, ["doc_id"]).collect())
    assert toxicity.with_scores(no_docs, blank, ["doc_id"]).collect() == []


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_output"]
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    calm = stages["toxicity"](spark, docs, sf_dir)
    assert calm.columns == docs.columns and 0.6 * len(rows) < calm.count() <= len(rows)
    near = stages["near_duplicates"](spark, docs, sf_dir)
    want = {i for i, _, c in brute.near(list(rows.items())) if i == c}
    assert near.columns == docs.columns and sorted(r["doc_id"] for r in near.collect()) == sorted(want)
    clean = stages["decontamination"](spark, docs, sf_dir)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _, hit, _ in brute.leaks(list(rows.items()), items) if not hit)
    mixed = stages["mixing"](spark, docs, sf_dir)
    copies = {r["doc_id"]: r["copies"] for r in mixing.taken_copies(docs).collect()}
    got = defaultdict(int)
    for r in mixed.collect():
        got[r["doc_id"]] += 1
        assert r["text"] == rows[r["doc_id"]]
    assert mixed.columns == docs.columns and got == {i: n for i, n in copies.items() if n}
    tokens = stages["token_output"](spark, mixed, sf_dir).orderBy("start").collect()
    assert [r["doc_id"] for r in tokens] == sorted(i for i, n in copies.items() for _ in range(n))


def test_pipeline_of_empty_documents(spark, tmp_path, no_docs):
    folder = str(tmp_path)
    no_docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_near_join_of_repeated_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, a), (5, b), (3, a), (9, b), (9, b), (None, "c d e"), (None, None)]
    got = sorted((r["doc"], r["n"], r["component"]) for r in near_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    low = -(2**63)
    assert got == sorted([(5, 26, 3), (5, 26, 3), (3, 26, 3), (9, 26, 3), (9, 26, 3), (low, 1, low), (low, 0, low)])


def test_pipeline_stages_of_awkward_rows(spark, tmp_path, awkward):
    """Nulls, repeats and columns named as the stages name theirs."""
    folder = str(tmp_path)
    clashing = awkward.selectExpr("*", "'a' AS toxicity_score", "1 AS kept_doc", "'t' AS scored_text")
    spark.createDataFrame([(i * 3, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(None, "nothing of this kind")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, clashing, folder)
        assert made.columns == clashing.columns, name
        assert made.count() > 0
    near = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, clashing, folder)
    ids = [r["doc_id"] for r in near.collect()]
    rows = [(i, t) for i, t in ((r["doc_id"], r["text"]) for r in awkward.collect())]
    want = {i for i, _, c in brute.near([(-(2**63) if i is None else i, t) for i, t in rows]) if i == c}
    assert {-(2**63) if i is None else i for i in ids} == want
    assert dict(corpus_pipeline.STAGES)["token_output"](spark, clashing, folder).count() == clashing.count()


def test_near_join_query_gives_null_ids_back(spark, tmp_path):
    from rimsight.llm.queries_near import op5_near_join

    text = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(None, text), (4, text), (5, "x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, op5_near_join(spark, str(tmp_path)).collect()), key=repr) == sorted([(None, 16, None), (4, 16, None), (5, 1, 5)], key=repr)


def test_components_of_stars_chains_and_loops(spark):
    from rimsight.llm.components import components

    star = [(1000, i) for i in range(1, 300)]
    chain = [(2000 + i, 2001 + i) for i in range(70)]
    odd = [(5000, 5000), (6000, 6001), (6001, 6000), (-7, 7007), (7007, 7008)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(star + chain + odd, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in (1, 299, 1000)) and all(got[2000 + i] == 2000 for i in range(71))
    assert 5000 not in got and got[6001] == 6000 and got[7008] == -7
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
