"""op3: repeated byte strings removed from all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.llm import suffix_dedup
from rimsight.llm.registry import query


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = suffix_dedup.without_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
