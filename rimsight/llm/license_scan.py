"""License scan: phrases in place, and text blocks that contain a license template."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimsight.llm.columns import PLAIN_WORD, ascii_lower, doc_key
from rimsight.llm.shared import held

# Phrase and label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label and opening words of well-known public license notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
CONTAINMENT = 0.9
BLOCK_BREAK = r"\n[ \t\r]*\n"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
ANY_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words_of(text: Column) -> Column:
    """Lower-case words; null text has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(PLAIN_WORD + "+"), F.lit(0))


def template_words(text: str) -> list[str]:
    """Distinct words of a template, in the rule of ``words_of``."""
    kept = "".join(c.lower() if c.isascii() else c for c in text)
    return list(dict.fromkeys("".join(c if c.isalnum() or not c.isascii() else " " for c in kept).split()))


def phrase_places(docs: DataFrame, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """Per row: doc, text_hash, n_words, n_base, first_word, last_word and ``found`` (labels, sorted).

    Only texts in which the one pattern of all phrases occurs are cut into words.
    """
    pattern = "|".join((ANY_GAP + "+").join(p.split()) for p in phrases)
    text = F.coalesce(F.col("text"), F.lit(""))
    maybe = text.rlike(f"(?i)(?<!{ANY_WORD})(?:{pattern})(?!{ANY_WORD})")
    base = docs.select(
        doc_key("doc_id").alias("doc"),
        F.col("doc_id"),
        F.xxhash64(F.lit(7), F.col("text")).alias("text_hash"),
        F.regexp_count(text, F.lit(ANY_WORD + "+")).cast("long").alias("n_words"),
        F.when(maybe, words_of(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("words"),
    )

    def starts(phrase: str) -> Column:
        parts = phrase.split()
        at = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(at, lambda i: reduce(lambda a, b: a & b, [F.get("words", i + k) == w for k, w in enumerate(parts)]))

    placed = base.withColumns({f"at_{n}": starts(p) for n, p in enumerate(phrases)})
    every = F.concat(*[F.col(f"at_{n}") for n in range(len(phrases))])
    found = F.array_compact(F.array(*[F.when(F.size(f"at_{n}") > 0, F.lit(x)) for n, x in enumerate(phrases.values())]))
    return placed.select(
        "doc",
        "doc_id",
        "text_hash",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(found)).alias("found"),
    )


def template_blocks(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """Every text block (paragraph) that holds at least ``containment`` of a template's words.

    Returns doc, text_hash, block, label, share. Exact: words outside the templates change no
    overlap, so blocks keep only template words, in order of how many blocks hold each, the
    rarest first. A block can reach a template's overlap only if it is long enough, if one of
    the rarest words of either meets one of the other, and if enough words follow those that
    met; what passes is counted in full. The templates' words are few by contract (the
    caller's list), so their side of the join is broadcast.
    """
    spark = docs.sparkSession
    sets = [(n, label, template_words(text)) for n, (label, text) in enumerate(templates)]
    need = {n: math.ceil(round(containment * len(words), 9)) for n, _, words in sets}
    vocabulary = sorted({w for _, _, words in sets for w in words})
    least = min(need.values())
    blocks = docs.select(
        doc_key("doc_id").alias("doc"),
        F.xxhash64(F.lit(7), F.col("text")).alias("text_hash"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), BLOCK_BREAK)).alias("block", "part"),
    )
    known = blocks.select(
        "doc", "text_hash", "block", F.array_intersect(F.array(*map(F.lit, vocabulary)), words_of(F.col("part"))).alias("tokens")
    )
    long_enough = held(known.filter(F.size("tokens") >= least), "license-blocks")
    counts = long_enough.select(F.explode("tokens").alias("token")).groupBy("token").count()
    seen = {r["token"]: r["count"] for r in counts.collect()}  # at most the templates' words
    ordered = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(ordered)}
    heads = []
    for n, label, words in sets:
        by_rank = sorted(words, key=rank.__getitem__)
        for at, word in enumerate(by_rank[: len(words) - need[n] + 1]):
            heads.append((word, n, label, at, len(words), need[n], by_rank))
    head_schema = "token string, template int, label string, t_at int, t_size int, need int, t_words array<string>"
    prefixes = F.broadcast(spark.createDataFrame(heads, head_schema))
    by_rank = long_enough.select(
        "doc", "text_hash", "block", F.array_intersect(F.array(*map(F.lit, ordered)), F.col("tokens")).alias("tokens")
    )
    rarest = by_rank.select("*", F.posexplode(F.slice("tokens", F.lit(1), F.size("tokens") - least + 1)).alias("b_at", "token"))
    met = rarest.join(prefixes, "token").filter(
        (F.size("tokens") >= F.col("need"))
        & (F.col("b_at") <= F.size("tokens") - F.col("need"))
        & (F.least(F.col("t_size") - F.col("t_at"), F.size("tokens") - F.col("b_at")) >= F.col("need"))
    )
    overlap = F.size(F.array_intersect("tokens", "t_words"))
    return (
        met.dropDuplicates(["doc", "text_hash", "block", "template"])
        .filter(overlap >= F.col("need"))
        .select("doc", "text_hash", "block", "label", (overlap / F.col("t_size")).alias("share"))
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document row: phrases, labels of phrases and templates, score.

    A null text has no words and no labels; a null id is kept as null. Rows with equal id and
    text give equal results; rows with equal id and different texts are scanned apart. The
    score is 1 where a phrase stands, else the largest share of a template found, else 0.
    """
    found = (
        template_blocks(docs)
        .groupBy("doc", "text_hash")
        .agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    )
    rows = phrase_places(docs).join(found, ["doc", "text_hash"], "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("found", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("found", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
