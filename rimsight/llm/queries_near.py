"""op5: near-duplicate components of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.llm import near_join
from rimsight.llm.columns import NO_ID, NOT_BLANK
from rimsight.llm.registry import query

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{NOT_BLANK}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + least(len(w), 5)], ' ') AS g
      FROM (SELECT *, unnest(range(len(w) - least(len(w), 5) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""


@query("op5_near_join", NEAR_SQL)
def op5_near_join(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def known(key):  # a null id is sorted before all others and null again here
        return F.when(F.col(key) != NO_ID, F.col(key))

    return near_join.classes(docs).select(known("doc").alias("doc_id"), F.col("n").alias("n_shingles"), known("component").alias("component_id"))
