"""WARC archives, token files and repeated strings: round trips and brute force."""

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from rimsight.llm import suffix_dedup, token_files, warc
from rimsight.llm.elias_fano import EliasFano
from rimsight.llm.queries_tokens import word_tokenizer


@pytest.mark.parametrize("n,step", [(0, 1), (1, 0), (5, 3), (1500, 0), (3000, 10), (3000, 100_000), (513, 1)])
def test_elias_fano(n, step):
    rng = np.random.default_rng(n + step)
    values = np.cumsum(rng.integers(0, step + 1, n)).astype(np.uint64)
    made = EliasFano.from_bytes(EliasFano.encode(values).to_bytes())
    assert (made.values() == values).all()
    for i in rng.integers(0, max(n, 1), min(n, 60)).tolist():
        assert made.select(i) == int(values[i])
        assert (made.values(i, 9) == values[i : i + 9]).all()
    with pytest.raises(IndexError):
        made.select(n)
    if n:
        assert len(made.to_bytes()) < 32 + n * (2 + np.log2(max(2, int(values[-1]) / n))) / 8 + n / 60 + 8


def test_pieces_encode_as_whole_texts():
    encoder = token_files.PieceEncoder.of(word_tokenizer())
    assert encoder.by_piece
    texts = [
        "", "It's 's 'S don'T naïve Über ÉCOLE 12 3½ ² x .'s !!'re", "\x1cq \x85 ﬁ ŉ Σς İ ￼", "ĲŸ ǅ ſ 日本語 x", "\x00 a", "<|endoftext|>a",
        "é à", "tab\tnew\nline\r\n", "''s''t", "hello" * 300, "a.b,c;d!?e--f__g", " nbsp", "123 4567 8.9", "ÀÉÎÕÜ àéîõü ß ƒ Ɏ",
    ]
    for _ in range(2):  # learned and known pieces alike
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
        assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_latin_letter_inside_a_word():
    encoder = token_files.PieceEncoder(word_tokenizer())
    texts = [f"{c}arna D{c}I s{c}" for c in map(chr, range(0xC0, 0x250))]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files_awkward(spark, awkward, no_docs, tmp_path):
    shards = token_files.write_shards(awkward, f"{tmp_path}/a", word_tokenizer())
    got = sorted(map(tuple, token_files.read_shards(shards).collect()), key=lambda r: r[1])
    encoder = token_files.PieceEncoder.of(word_tokenizer()).tokenizer
    rows = sorted(((r["doc_id"], r["text"] or "") for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at, want = 0, []
    for doc, text in rows:
        ids = np.array(encoder.encode(text, add_special_tokens=False).ids + [2], "<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    for r in shards.collect():  # random access to every document
        shard = token_files.Shard(r["uri"])
        assert len(shard) == r["n_docs"]
        assert [shard.document(i).tolist() for i in range(len(shard))] == [ids.tolist() for _, _, ids in shard.rows(step=2)]
    assert token_files.read_shards(token_files.write_shards(no_docs, f"{tmp_path}/b", word_tokenizer())).collect() == []


def test_token_shards_negative_and_far_ids(spark, tmp_path):
    rows = [(i, "a b") for i in (-(2**63), -5, 0, 2**63 - 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = token_files.read_shards(token_files.write_shards(docs, f"{tmp_path}/a", word_tokenizer())).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [i for i, _ in rows]


def test_warc_awkward(spark, tmp_path):
    body = "<p>Übung</p>" * 40
    rows = [(9, "http://a b/\r\nX: y", body), (3, None, body), (4, "u", None), (5, "u", ""), (5, "u", body), (None, "u", body), (7, "u", "x\r\n\r\nWARC/1.1\r\n"), (3, "v", body), (8, "u", "z" * 500_000)]
    pages = spark.createDataFrame([(*r, "refers_to", 1) for r in rows], "page_id long, url string, html string, digest string, refers_to int").repartition(2)
    archives = warc.write_archives(pages, f"{tmp_path}/w")
    got = sorted(map(tuple, warc.read_archives(archives).collect()), key=str)

    def row(page, html, first):
        raw = (html or "").encode()
        again = page is not None and page > first
        return (page, len(raw), warc.sha1_base32(raw), "revisit" if again else "response", first if again else None)

    firsts = {}
    for page, _, html in rows:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    assert got == sorted((row(p, h, firsts[h or ""]) for p, _, h in rows), key=str)
    with pytest.raises(StopIteration):
        next(iter(warc.read_archives(warc.write_archives(pages.limit(0), f"{tmp_path}/e")).collect()))


def test_warc_frames_stand_alone(tmp_path):
    pages = [warc.record(i, f"http://h/{i}", f"<html>{'same words ' * 30}{i}</html>".encode(), "D", None) for i in range(500)]
    path = f"{tmp_path}/one.warc.zst"
    with open(path, "wb") as out:
        n, size = warc.write_archive(out, iter(pages))
    raw = open(path, "rb").read()
    assert (n, size) == (500, len(raw))
    magic, length = warc.FRAME.unpack(raw[:8])
    assert magic == warc.SKIPPABLE
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + length])))
    rest, seen = raw[8 + length :], []
    while rest:
        one = opener.decompressobj()
        seen.append(one.decompress(rest))
        rest = one.unused_data
    assert seen == pages
    assert len(raw) - 8 - length < 0.6 * sum(len(zstandard.ZstdCompressor(level=3).compress(p)) for p in pages)
    open(path, "wb").write(raw[:-3])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(path))


def removed(df):
    return {
        r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in suffix_dedup.without_repeats(df).collect()
    }


def test_suffix_dedup_random(spark, monkeypatch):
    rng = random.Random(3)
    base = "".join(rng.choice("abcd ") for _ in range(700))
    rows = []
    for i in range(60):
        kind = rng.random()
        if kind < 0.2:
            text = base[rng.randrange(300) :][: rng.randrange(50, 400)]
        elif kind < 0.4:
            text = "".join(rng.choice("ab") for _ in range(rng.randrange(300))) + base[100:330] + "é" * rng.randrange(120)
        elif kind < 0.6:
            text = rng.choice(["a", "ab", "abc" * 9]) * rng.randrange(300)
        elif kind < 0.7:
            text = None if rng.random() < 0.3 else "x" * 99
        else:
            near = list(base)
            for _ in range(rng.randrange(8)):
                near[rng.randrange(len(near))] = rng.choice("abcd")
            text = "".join(near)
        rows.append((i, text, "clash", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, doc string, lo int").repartition(5)
    assert removed(docs) == brute.repeats([r[:2] for r in rows])


def test_suffix_dedup_group_of_any_size(spark, monkeypatch):
    rng = random.Random(8)
    base = "".join(rng.choice("abcd ") for _ in range(300))
    rows = []
    for i in range(120):  # one passage in different surroundings, some of them shared
        around = ["".join(random.Random(rng.randrange(60)).choice("xyz\0") for _ in range(90)) for _ in range(2)]
        rows.append((i, around[0][rng.randrange(80) :] + base + around[1][: rng.randrange(90)]))
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 10)
    monkeypatch.setattr(suffix_dedup, "STARTS_ROWS", 7)
    sizes = []
    settle = suffix_dedup._settle

    def small(contexts):
        sizes.extend(r["count"] for r in contexts.groupBy("sure").count().collect())
        return settle(contexts)

    monkeypatch.setattr(suffix_dedup, "_settle", small)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(docs) == brute.repeats(rows)
    assert max(sizes, default=0) <= 10


def test_suffix_dedup_short_context_among_nuls():
    contexts = [b"\0" * 100, b"x" * 60 + b"\0" * 40, b"\0" * 101]
    doc, lo, hi, trigger = (np.array(c) for c in ([1, 2, 3], [0, 0, 0], [0, 0, 1], [0, 60, 0]))
    out = suffix_dedup.repeated_starts(np.zeros(3, np.int64), doc, lo, hi, trigger, contexts)
    assert out[:, 0].tolist() == [False, False, True]


def test_suffix_dedup_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    ends = np.array([0, 50, 50, 1700, 3000])

    def owners():
        out = {}
        for text, lo, hi, trigger, sure, _ in suffix_dedup.phrases(data, ends):
            for t, a, b, g, s in zip(text, lo, hi, trigger, sure):
                for start in range(a, b + 1):
                    assert out.setdefault((t, start), (g, s)) == (g, s)
        return out

    whole = owners()
    assert len(whole) == sum(max(0, b - a - 99) for a, b in zip(ends[:-1], ends[1:]))
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    assert owners() == whole


def test_suffix_dedup_awkward(awkward, no_docs):
    got = removed(awkward.filter("doc_id is not null"))
    rows = {r["doc_id"]: r["text"] for r in awkward.filter("doc_id is not null").collect()}
    assert got == brute.repeats(sorted(rows.items()))  # the repeated row comes back as its first
    with_null = removed(awkward)
    base = {r["doc_id"]: r["text"] for r in awkward.collect()}
    order = sorted(base.items(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert with_null == brute.repeats(order)
    assert removed(no_docs) == {}


def test_suffix_dedup_repeated_id(spark):
    rng = random.Random(1)
    text, more = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (150, 120))
    docs = spark.createDataFrame([(1, text), (1, text + more), (1, text), (2, text)], "doc_id long, text string")
    got = suffix_dedup.without_repeats(docs).withColumn("n", F.size("spans")).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n"]) for r in got)[-1] == (2, 150, 1)
    first = [r for r in got if r["doc_id"] == 1]
    # one order of the two texts: the later loses what the earlier has, equal rows agree
    assert sorted(r["n"] for r in first) in ([0, 0, 1], [0, 1, 1])
