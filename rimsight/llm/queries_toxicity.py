"""op1: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.llm import toxicity
from rimsight.llm.registry import query


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.with_scores(docs, model, ["doc_id", "lang"]).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"),
        (F.col("score") >= toxicity.threshold(model, F.col("lang"))).alias("flagged"),
    )
