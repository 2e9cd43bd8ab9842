"""op6: benchmark decontamination over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.llm import decontaminate
from rimsight.llm.columns import PLAIN_WORD
from rimsight.llm.registry import query

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LEAK_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{PLAIN_WORD}+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '{PLAIN_WORD}+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS g
       FROM (SELECT *, unnest(range(len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, i, size, array_to_string(w[i + 1 : i + size], ' ') AS g
       FROM (SELECT doc_id, w, size, unnest(range(len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT DISTINCT doc_id, i, size, item FROM dw JOIN bw USING (size, g)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op6_decontaminate", LEAK_SQL)
def op6_decontaminate(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.contamination(docs, items, unnamed=True).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
