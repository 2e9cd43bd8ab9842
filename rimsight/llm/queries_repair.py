"""op12: repair of damaged conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimsight.llm import repair
from rimsight.llm.registry import query


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or renamed by a checksum of conversation and turn; nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).drop("col")


# The edits as SQL: a value is ten digits of cost and the audit letters, so the least text is the best.


def _add(cost: int, letter: str, value: str) -> str:
    return f"(lpad(CAST(CAST({value}[1:10] AS BIGINT) + {cost} AS VARCHAR), 10, '0') || {value}[11:] || '{letter}')"


def _keep(cost: int, letter: str, value: str) -> str:
    return f"CASE WHEN cut THEN {_add(cost + 1, letter, value)} ELSE {_add(cost, letter, value)} END"


def _row(initial: str, *values: str) -> str:
    kept = [f"CASE WHEN NOT must AND initial = '{initial}' THEN {_keep(0, 'K', v)} END" for v in values]
    named = [f"CASE WHEN NOT must THEN {_keep(2, 'R', v)} END" for v in values] if initial != "s" else []
    return ", ".join(kept + named)


REPAIR_SQL = rf"""
WITH RECURSIVE steps AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
  FROM conversations),
kinds AS (SELECT conv_id, turn, role, text,
  xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS kind FROM keyed, steps),
rows_ AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS rn FROM rows_),
f AS (SELECT conv_id, turn, role, text, rn, role[1:1] AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again, regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z') AS open_,
  lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM placed),
g AS (SELECT *, blank OR again AS must, NOT blank AND NOT again AND open_ AS cut FROM f),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
  count(*) FILTER (cut) AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM g GROUP BY conv_id),
dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '0000000000' AS v0, CAST(NULL AS VARCHAR) AS v1, '0000000002I' AS v2, '0000000004II' AS v3 FROM counts
  UNION ALL SELECT conv_id, i, s0, s1, least(t2, {_add(2, 'I', 't3')}), least(t3, {_add(2, 'I', 't2')})
  FROM (SELECT *, least(s2, {_add(2, 'I', 's0')}, {_add(2, 'I', 's1')}, {_add(2, 'I', 's3')}) AS t2, least(s3, {_add(2, 'I', 's2')}) AS t3
    FROM (SELECT dp.conv_id, i + 1 AS i, {_add(3, 'D', 'v0')} AS s0, least({_add(3, 'D', 'v1')}, {_row('s', 'v0')}) AS s1,
        least({_add(3, 'D', 'v2')}, {_row('u', 'v0', 'v1', 'v3')}) AS s2, least({_add(3, 'D', 'v3')}, {_row('a', 'v2')}) AS s3
      FROM dp JOIN g ON g.conv_id IS NOT DISTINCT FROM dp.conv_id AND g.rn = dp.i + 1))),
best AS (SELECT counts.*, CAST(least(v0, v3)[1:10] AS BIGINT) AS cost, least(v0, v3)[11:] AS audit
  FROM counts JOIN dp ON counts.conv_id IS NOT DISTINCT FROM dp.conv_id AND counts.n = dp.i),
told AS (SELECT conv_id, audit, 0 AS p, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(NULL AS VARCHAR) AS body FROM best
  UNION ALL SELECT conv_id, audit, p + 1, CASE l WHEN 'I' THEN i ELSE i + 1 END,
    CASE l WHEN 'D' THEN q WHEN 'K' THEN CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE q WHEN 2 THEN 3 ELSE 2 END END,
    CASE l WHEN 'D' THEN body ELSE coalesce(body || chr(10), '') || CASE l WHEN 'K' THEN role ELSE CASE q WHEN 2 THEN 'assistant' ELSE 'user' END END || ':'
      || CASE l WHEN 'I' THEN '' ELSE text END END
  FROM (SELECT told.*, audit[p + 1:p + 1] AS l, g.role, g.text, g.initial FROM told LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM told.conv_id AND g.rn = told.i + 1
    WHERE p < len(audit))),
body AS (SELECT conv_id, coalesce(body, '') AS body FROM told WHERE p = len(audit))
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN body ON body.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op12_repair", REPAIR_SQL)
def op12_repair(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair.reports(damaged(rows)).withColumnRenamed("conv_id", "found_id")
    every = rows.select("conv_id").distinct()
    zero = F.lit(0).cast("long")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
