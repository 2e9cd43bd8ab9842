"""Token-id files: one id array per shard with Elias-Fano document boundaries."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimsight.llm.elias_fano import EliasFano
from rimsight.llm.files import open_file, whole_file
from rimsight.llm.shared import ship_package

END_ID = 2
MAGIC = b"TOKSHRD1"
# trailer: end of ids, of boundaries, of document ids; documents without an id; bytes of an id
_TRAILER = struct.Struct("<QQQQQ")

# Texts of these characters alone are cut into the tokenizer's own pieces below: what it puts
# into lower case, and what its pattern tells apart, is plain for them. Left out are the letters
# up to ɏ whose lower case is no letter of the pieces' class, such as Ɓ, Ɔ and Ə.
_LETTERS = [c for c in map(chr, range(0xC0, 0x250)) if re.fullmatch(r"[a-zß-öø-ɏ]", c.lower())]
_PLAIN = re.compile(rf"[\t\n\r -~{''.join(_LETTERS)}]*")
_PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ɏ]+|[0-9]|[^\sa-zß-öø-ɏ0-9]+", re.ASCII)
_KEPT = 700_000


class PieceEncoder:
    """Encodes texts with a tokenizer, each distinct piece once.

    The tokenizer cuts a text into pieces before it merges and never merges across them, so a
    text's ids are those of its pieces in a row. Texts outside ``_PLAIN``, or with a special
    token's string, go to the tokenizer whole.
    """

    _made: dict[str, PieceEncoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = "[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in str(self.tokenizer.pre_tokenizer)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces, many in one text between blanks, and tell them apart by their places in it."""
        for at in range(0, len(pieces), 4096):
            part = pieces[at : at + 4096]
            made = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            raw = np.array(made.ids, "<u4").tobytes()
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            upto = np.searchsorted([start for start, _ in made.offsets], ends, "left") * 4
            before = 0
            for piece, after in zip(part, upto.tolist()):
                self.kept[piece] = raw[before:after]
                before = after

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if len(self.kept) > _KEPT:
            self.kept.clear()
        known, cut, new = self.kept.get, [], {}
        for text in texts:
            if not (self.by_piece and _PLAIN.fullmatch(text)) or any(s in text for s in self.specials):
                cut.append(None)
                continue
            pieces = _PIECES.findall(text.lower())
            found = list(map(known, pieces))
            gaps, at = [], -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                gaps.append((at, pieces[at]))
                new[pieces[at]] = None
            cut.append((found, gaps))
        self._learn(list(new))
        out = []
        for text, done in zip(texts, cut):
            if done is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
                continue
            found, gaps = done
            for at, piece in gaps:
                found[at] = self.kept[piece]
            out.append(b"".join(found))
        return out


class ShardWriter:
    """Ids of documents in a row; boundaries and document ids follow when all are there."""

    def __init__(self, out, bits: int):
        self.out, self.kind = out, np.dtype("<u2" if bits <= 16 else "<u4")
        self.ends, self.ids, self.unnamed, self.total = [0], [], 0, 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(self.kind).tobytes())
        self.total += len(ids)
        self.ends.append(self.total)
        if doc_id is None:
            self.unnamed += 1
        else:
            self.ids.append(doc_id)

    def close(self) -> None:
        at = len(MAGIC) + self.total * self.kind.itemsize
        bounds = EliasFano.encode(np.array(self.ends, np.uint64)).to_bytes()
        first = self.ids[0] if self.ids else 0
        # ids are numbers from -2**63 on: the distance from the first fits 64 bits without a sign
        named = np.array(self.ids, np.int64).view(np.uint64) - np.array([first], np.int64).view(np.uint64)
        ids = struct.pack("<q", first) + EliasFano.encode(named).to_bytes()
        self.out.write(bounds)
        self.out.write(ids)
        self.out.write(_TRAILER.pack(at, at + len(bounds), at + len(bounds) + len(ids), self.unnamed, self.kind.itemsize))


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, uri: str):
        self.file = open_file(uri)
        size = self.file.size()
        self.ids_end, bounds_end, end, self.unnamed, width = _TRAILER.unpack(self.file.read_at(_TRAILER.size, size - _TRAILER.size))
        if self.file.read_at(len(MAGIC), 0) != MAGIC or end + _TRAILER.size != size:
            raise ValueError(f"{uri} is not a complete token shard")
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        self.bounds = EliasFano.from_bytes(self.file.read_at(bounds_end - self.ids_end, self.ids_end))
        raw = self.file.read_at(end - bounds_end, bounds_end)
        self.first = struct.unpack_from("<q", raw)[0]
        self.named = EliasFano.from_bytes(raw[8:])

    def __len__(self) -> int:
        return self.bounds.n - 1

    def doc_ids(self, at: int, count: int) -> list[int | None]:
        count = min(count, len(self) - at)
        blank = max(0, min(count, self.unnamed - at))
        named = self.named.values(max(0, at - self.unnamed), count - blank)
        return [None] * blank + (named + np.array([self.first], np.int64).view(np.uint64)).view(np.int64).tolist()

    def ids(self, start: int, end: int) -> np.ndarray:
        size = self.kind.itemsize
        return np.frombuffer(self.file.read_at((end - start) * size, len(MAGIC) + start * size), self.kind)

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.bounds.select(i), self.bounds.select(i + 1))

    def rows(self, step: int = 256) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Document id, start within the shard and ids of every document in order."""
        for at in range(0, len(self), step):
            bounds = self.bounds.values(at, step + 1).astype(np.int64)
            block = self.ids(int(bounds[0]), int(bounds[-1]))
            for doc_id, a, b in zip(self.doc_ids(at, step), bounds[:-1].tolist(), bounds[1:].tolist()):
                yield doc_id, a, block[a - bounds[0] : b - bounds[0]]


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents in order of doc_id; returns the shards: shard, uri, n_docs, n_ids, start.

    Reads doc_id and text. Documents are dealt out by range of id, one shard for each range
    that holds any; a null text is empty, a null id comes first, repeated ids stand in order
    of their texts. The list of shards, a row for each file, is what comes back to the driver.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        uri = f"{folder}/shard-{part:06d}.tok"
        encoder = PieceEncoder.of(tokenizer)
        with whole_file(uri) as out:
            writer = ShardWriter(out, (max(encoder.tokenizer.get_vocab_size(), end_id + 1) - 1).bit_length())

            def add(batch: pa.RecordBatch) -> None:
                for at in range(0, len(batch), 256):
                    some = batch.slice(at, 256)
                    for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                        writer.add(doc_id, np.frombuffer(ids + end, "<u4"))

            add(first)
            for batch in batches:
                add(batch)
            writer.close()
        yield pa.RecordBatch.from_pydict(
            {"shard": [part], "uri": [uri], "n_docs": [len(writer.ends) - 1], "n_ids": [writer.total]},
            schema=pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
        )

    listed, start = [], 0
    for r in sorted(ranged.mapInArrow(run, "shard int, uri string, n_docs long, n_ids long").collect(), key=lambda r: r["shard"]):
        listed.append((r["shard"], r["uri"], r["n_docs"], r["n_ids"], start))
        start += r["n_ids"]
    return spark.createDataFrame(listed, "shard int, uri string, n_docs long, n_ids long, start long")


def read_shards(shards: DataFrame) -> DataFrame:
    """Every document of the shards: doc_id, start, n_tokens, ids_crc32."""
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc_id, at, ids in Shard(uri).rows():
                    rows.append((doc_id, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    n = max(1, shards.count())
    return shards.select("uri", "start").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
