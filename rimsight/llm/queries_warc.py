"""op2: all pages as WARC archives, read back."""

from __future__ import annotations

from rimsight.llm import warc
from rimsight.llm.registry import query
from rimsight.session import scratch_path

_BITS = "CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR)"

WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, {_BITS} AS bits, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         CAST(substr(bits, 5 * i + 1, 1) AS INT) * 16 + CAST(substr(bits, 5 * i + 2, 1) AS INT) * 8 + CAST(substr(bits, 5 * i + 3, 1) AS INT) * 4
         + CAST(substr(bits, 5 * i + 4, 1) AS INT) * 2 + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
"""


@query("op2_warc", WARC_SQL)
def op2_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return warc.read_archives(warc.write_archives(pages, scratch_path(spark, "warc")))
