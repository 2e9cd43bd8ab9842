"""Word, n-gram and line operators against plain Python on awkward rows."""

import random

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rimsight.llm import decontaminate, license_scan, line_dedup, near_join
from rimsight.llm import words as W
from rimsight.llm.components import components

NULL_ID = -(2**63)


def pairs(df, first=NULL_ID):
    return [(first if r["doc_id"] is None else r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_word_hashes_at_any_piece_size(monkeypatch):
    texts = ["Hello wörld  foo", "", None, "foo", "x" * 50 + " foo\tHello", " a b ", "\x00 q\x00", "\x01"]
    for table, pattern in ((W.BLANK_SPLIT, brute.BLANK), (W.PLAIN_SPLIT, brute.PLAIN)):
        for size in (1 << 18, 7, 16):
            monkeypatch.setattr(W, "CHUNK", size)
            hashes, ends, (heads,) = W.word_hashes(*W.utf8(pa.array(texts)), table, (2,))
            words = [pattern.findall(brute.low(t)) for t in texts]
            assert list(np.diff(ends)) == [len(w) for w in words]
            flat = [w for own in words for w in own]
            assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
            assert len(set(heads.tolist())) == len({w.encode()[:2] for w in flat})


def test_near_join_awkward(awkward):
    got = sorted((r["doc"], r["n"], r["component"]) for r in near_join.classes(awkward).collect())
    assert got == brute.near(pairs(awkward))


def test_near_join_chain_and_border(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, text = [], words[:120]
    for i in range(40):  # a drifting chain: neighbours link, far ones do not
        rows.append((100 - i, " ".join(text)))
        text = text[:]
        for _ in range(rng.randrange(1, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
    for i in range(60):  # short sets about the border
        rows.append((200 + i, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 14)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc"], r["n"], r["component"]) for r in near_join.classes(docs).collect())
    assert got == brute.near(rows)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for size in [1, 2, 3, 5, 8, 9, 10, 13, 20, 33, 50, 81, 200, 500, 1500] * 6:
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        most = len(a) // 5
        gone = int(rng.integers(0, most + 1))
        # |a| - gone common, extra more: still 0.8 of the union
        extra = int((len(a) - gone) * 10 // 8 - len(a))
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, max(extra, 0), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        owner, sig = near_join.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist())
        assert near_join.may_link(near_join.parity_sketch(a), near_join.parity_sketch(b), len(a), len(b))


def test_short_texts_share_no_signatures(spark):
    rows = [(n * 1000 + i, " ".join(f"w{n}x{i}y{k}" for k in range(n))) for n in range(1, 12) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_join.signature_rows(docs).groupBy("sig").count()
    assert found.filter("count > 1").count() == 0
    assert not near_join.signature_rows(docs.filter("doc_id < 7900")).count()


def test_small_linked_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for size in range(1, 14):
        for other in range(size, 18):
            for common in range(1, size + 1):
                if 100 * common < 80 * (size + other - common):
                    continue
                for _ in range(40):
                    pool = rng.integers(0, 2**63, size + other, dtype=np.uint64)
                    a, b = np.sort(pool[:size]), np.sort(pool[size - common : size - common + other])
                    owner, sig = near_join.signatures(np.concatenate([a, b]), np.array([0, size, size + other]))
                    assert set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist()), (size, other, common)


def test_near_join_empty(no_docs):
    assert near_join.classes(no_docs).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 175)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 150, 150: 150, 175: 150}
    assert got == want


def test_decontaminate_awkward(spark, awkward):
    base = " ".join(f"word{i} of passage" for i in range(60))
    items = [(1, base[40:260]), (2, "two words"), (3, None), (4, ""), (5, "not there at all in any of these texts, is it"), (None, base), (7, "LONG3 long4 long5 long6 long7 long8 long9 long10 long11 long12 long13"), (7, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(
        (NULL_ID if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.contamination(awkward, bench).collect()
    )
    assert got == sorted(brute.leaks(pairs(awkward), items))
    clean = decontaminate.clean(awkward, bench)
    assert clean.columns == awkward.columns
    assert sorted(map(str, pairs(clean))) == sorted(str(p) for p, w in zip(pairs(awkward), brute.leaks(pairs(awkward), items)) if not w[2])


def test_decontaminate_items_without_id(spark, tmp_path):
    import corpus_pipeline
    from rimsight.llm.queries_decontaminate import op6_decontaminate

    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (2, text[:26]), (3, "end " + text[-45:])], "doc_id long, text string")
    items = spark.createDataFrame([(None, text), (5, text[-45:]), (None, "of its own")], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in op6_decontaminate(spark, str(tmp_path)).collect()}
    assert got == {1: (30, 30, 1, True), 2: (9, 0, 0, False), 3: (13, 12, 1, True)}
    only = spark.createDataFrame([(None, text)], "item_id long, text string")
    only.write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()] == [2]


def test_decontaminate_empty(spark, awkward, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(no_docs, none).collect() == []
    assert decontaminate.contamination(awkward, none).filter("n_hit > 0").count() == 0
    assert decontaminate.clean(awkward, none).count() == awkward.count()


def test_line_dedup_awkward(awkward):
    split = line_dedup.kept_lines(awkward, line_dedup.keep_bitmaps(awkward))
    got = sorted(
        (NULL_ID if r["doc_id"] is None else r["doc_id"], len(r["lines"]), len(r["lines"]) - len(r["kept"]), r["sha"])
        for r in split.withColumn("sha", F.sha2(F.array_join("kept", "\n"), 256)).collect()
    )
    want = sorted(brute.kept_lines(pairs(awkward)))
    assert got == want
    assert sum(w[2] for w in want) > 5


def test_line_dedup_long_document(spark):
    line = "a line of more than forty characters that everybody has"
    rows = [(i, "\n".join(f"own {i} {k}" if k % 3 else line for k in range(100))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    split = line_dedup.kept_lines(docs, line_dedup.keep_bitmaps(docs))
    assert {r["doc_id"]: len(r["kept"]) for r in split.collect()} == {i: 66 for i in range(5)} | {5: 100}


def test_line_dedup_empty(no_docs):
    assert line_dedup.kept_lines(no_docs, line_dedup.keep_bitmaps(no_docs)).collect() == []


def test_license_scan_awkward(awkward, no_docs):
    got = {}
    for r in license_scan.scan(awkward).collect():
        got.setdefault(r["doc_id"], r)
    rows = dict(pairs(awkward, None))
    for doc, text in rows.items():
        words = brute.PLAIN.findall(brute.low(text))
        starts = [
            (i, label)
            for phrase, label in license_scan.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        r = got[doc]
        assert (r["n_words"], r["n_base"]) == (len(words), len(starts))
        assert (r["first_word"], r["last_word"]) == ((min(starts)[0], max(starts)[0]) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in starts}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not starts
    assert sum("apache-2.0" in r["labels"] for r in got.values()) == 1
    assert license_scan.scan(awkward).count() == awkward.count()
    assert license_scan.scan(no_docs).collect() == []


def test_license_blocks_against_every_pair(spark):
    rng = random.Random(2)
    words = sorted({w for _, t in license_scan.TEMPLATES for w in license_scan.template_words(t)})
    rows = []
    for i in range(60):
        _, template = rng.choice(license_scan.TEMPLATES)
        own = [w for w in license_scan.template_words(template) if rng.random() > 0.07] + rng.sample(words, 3)
        rng.shuffle(own)
        rows.append((i, "intro text\n\n" + " ".join(own) + "\n \nend"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc"], r["label"], round(r["share"], 9)) for r in license_scan.template_blocks(docs).collect()}
    want = set()
    for i, text in rows:
        block = set(text.split("\n\n")[1].split("\n")[0].split())
        for label, template in license_scan.TEMPLATES:
            own = set(license_scan.template_words(template))
            if len(own & block) >= license_scan.CONTAINMENT * len(own) - 1e-9:
                want.add((i, label, round(len(own & block) / len(own), 9)))
    assert got == want
    assert len(want) > 10
