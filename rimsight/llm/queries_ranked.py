"""op13: the ten best documents for each benchmark item."""

from __future__ import annotations

from rimsight.llm import ranked_search
from rimsight.llm.registry import query

_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

RANKED_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
filled AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM filled),
q AS (SELECT item_id, t, CAST(count(*) AS BIGINT) AS repeats FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, n, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM filled) SEMI JOIN q USING (t) GROUP BY ALL),
h AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
      FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
i AS (SELECT doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS gain FROM p JOIN h USING (t), s),
r AS (SELECT item_id, doc_id, CAST(sum(gain * repeats) AS BIGINT) AS score FROM i JOIN q USING (t) GROUP BY ALL HAVING sum(gain * repeats) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM r QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query("op13_ranked_search", RANKED_SQL)
def op13_ranked_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return ranked_search.ranked(docs, items)
