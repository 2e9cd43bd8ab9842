"""op4: all documents mixed to target weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.llm import mixing
from rimsight.llm.columns import NOT_BLANK
from rimsight.llm.registry import query

_NAMED = f"'{mixing.SEED}' || coalesce('=' || source, '-')"

MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{NOT_BLANK}')) AS BIGINT) AS size FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS weight
      FROM d GROUP BY source),
l AS (SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size / weight, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM t),
f AS (SELECT *, source_size * 2.0::DOUBLE <= weight * level AS is_full FROM l),
g AS (SELECT source, source_size, CASE WHEN is_full THEN source_size * 2.0::DOUBLE
             ELSE weight * (SELECT arg_min(level, source_size / weight) FROM f WHERE NOT is_full) END AS target,
             CAST(CAST('0x' || substr(md5({_NAMED}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS u FROM f),
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS DOUBLE) AS place FROM d)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size > 0 THEN CAST(size * (floor(target / source_size * place + u) - floor(target / source_size * (place - 1) + u)) AS BIGINT)
            ELSE 0 END AS taken
FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source
"""


@query("op4_mix", MIX_SQL)
def op4_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixing.taken_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
