"""op9 and op10: license scan and line de-duplication over all documents."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from rimsight.llm import license_scan, line_dedup
from rimsight.llm.columns import PLAIN_WORD
from rimsight.llm.registry import query

LINE_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS bare
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), keyed AS (
  SELECT doc_id, pos, line, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
  SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AND doc_id < last_doc AS lost FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""




def _license_sql() -> str:
    starts, labels = [], []
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        test = " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(parts))
        starts.append(f"list_filter(range(len(words)), lambda i: {test})")
        labels.append(label)
    cols = ", ".join(f"{s} AS at_{n}" for n, s in enumerate(starts))
    every = "list_concat(" * (len(starts) - 1) + "at_0" + "".join(f", at_{n})" for n in range(1, len(starts)))
    found = "[" + ", ".join(f"CASE WHEN len(at_{n}) > 0 THEN '{x}' END" for n, x in enumerate(labels)) + "]"
    sets = []
    for label, text in license_scan.TEMPLATES:
        words = license_scan.template_words(text)
        need = math.ceil(round(license_scan.CONTAINMENT * len(words), 9))
        sets.append(f"('{label}', {words!r}, {need})")
    word = PLAIN_WORD + "+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH base AS (SELECT doc_id, {low} AS low FROM documents),
split AS (SELECT doc_id, low, regexp_extract_all(low, '{word}') AS words FROM base),
placed AS (SELECT doc_id, len(words) AS n_words, {cols} FROM split),
based AS (SELECT doc_id, n_words, {every} AS every, list_filter({found}, lambda x: x IS NOT NULL) AS found FROM placed),
templates(label, t, need) AS (VALUES {", ".join(sets)}),
parts AS (SELECT doc_id, list_distinct(regexp_extract_all(part, '{word}')) AS words
          FROM (SELECT doc_id, unnest(regexp_split_to_array(low, '\n[ \t\r]*\n')) AS part FROM base)),
hits AS (SELECT doc_id, label, len(list_intersect(words, t)) / len(t) AS share FROM parts, templates
         WHERE len(list_intersect(words, t)) >= need),
more AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS share FROM hits GROUP BY doc_id)
SELECT doc_id, n_words, len(every) AS n_base, list_min(every) AS first_word, list_max(every) AS last_word,
       array_to_string(list_sort(found), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(found, coalesce(more, [])))), ',') AS labels,
       CASE WHEN len(every) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM based LEFT JOIN more USING (doc_id)
"""


@query("op9_license_scan", _license_sql())
def op9_license_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_scan.scan(docs)


@query("op10_line_dedup", LINE_SQL)
def op10_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    split = line_dedup.kept_lines(docs, line_dedup.keep_bitmaps(docs))
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )
