"""op11: quality of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.llm import quality
from rimsight.llm.registry import query


@query("op11_quality")
def op11_quality(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.with_scores(docs, model, ["doc_id"]).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )
