"""Line de-duplication: per-document keep bitmaps for lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimsight.llm.columns import BLANKS, ascii_lower, doc_key, fresh
from rimsight.llm.shared import held

MIN_CHARS = 40
MIN_DOCS = 5
WORD = 32  # bits of a bitmap word


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line long enough to count: two hashes of its key, document, position."""
    texts = docs.select(
        doc_key("doc_id").alias("doc"),
        F.xxhash64(F.lit(7), F.col("text")).alias("text_hash"),
        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"),
    ).filter(F.octet_length("line") >= min_chars)
    keyed = texts.select("doc", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "text_hash", "pos"
    )


def shared_keys(occurrences: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keys found in at least ``min_docs`` documents with the largest document that holds each.

    Occurrences are dealt out by range of (hash, document) and sorted by document and
    position, so the first one of each document streams past and the rest fall away; the
    counts of a key whose documents span several ranges are added up afterwards, so no key
    needs one task.
    """
    ranged = occurrences.select("h1", "h2", "doc", "pos").repartitionByRange("h1", "h2", "doc")
    firsts = ranged.sortWithinPartitions("h1", "h2", "doc", "pos").groupBy("h1", "h2", "doc").agg(F.min("pos").alias("pos"))
    return (
        firsts.groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc"))
        .filter(F.col("n_docs") >= min_docs)
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Compressed keep bitmap of every document that loses a line.

    Reads ``doc_id`` and ``text``. Returns doc, text_hash and ``words``, a map from word
    number to a word whose set bits are the lines kept (line = 32 * number + bit). A word
    that would be all ones is left out, and so is a document that keeps every line.

    A null id counts as one document that precedes all others; a null or empty text is one
    empty line. Rows with one id are one document when documents are counted; each keeps
    its own bitmap, told apart by a hash of its text.
    """
    seen = held(_occurrences(docs, min_chars), "line-hashes")
    lost = (
        seen.join(shared_keys(seen, min_docs), ["h1", "h2"])
        .filter(F.col("doc") < F.col("last_doc"))
        .select(
            "doc",
            "text_hash",
            F.shiftright("pos", 5).alias("word"),
            F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD).alias("bit"),
        )
    )
    words = lost.groupBy("doc", "text_hash", "word").agg(
        (F.lit(2**WORD - 1).bitwiseXOR(F.bit_or("bit"))).alias("bits")
    )
    return words.groupBy("doc", "text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words")
    )


def kept_lines(docs: DataFrame, bitmaps: DataFrame, lines: str = "lines", kept: str = "kept") -> DataFrame:
    """``docs`` with an array of all its lines and one of those that its bitmap keeps.

    The two new columns replace any of the same name.
    """
    doc, text_hash, words = fresh(docs.select("*", F.lit(0).alias(lines), F.lit(0).alias(kept)), "doc", "text_hash", "words")
    left = docs.withColumns({doc: doc_key("doc_id"), text_hash: F.xxhash64(F.lit(7), F.col("text"))})
    marks = bitmaps.select(F.col("doc").alias(doc), F.col("text_hash").alias(text_hash), F.col("words").alias(words))
    joined = left.join(marks.hint("shuffle_hash"), [doc, text_hash], "left")

    def stays(_: Column, pos: Column) -> Column:
        word = F.element_at(words, F.shiftright(pos, 5))
        return word.isNull() | (F.call_function("shiftright", word, pos % WORD).bitwiseAND(F.lit(1)) == 1)

    split = joined.withColumn(lines, lines_of(F.col("text")))
    return split.withColumn(kept, F.when(F.col(words).isNull(), F.col(lines)).otherwise(F.filter(lines, stays))).drop(
        doc, text_hash, words
    )
