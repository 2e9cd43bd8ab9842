"""A corpus from raw documents to token files, in stages that each read what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimsight.llm import decontaminate, mixing, near_join, token_files, toxicity
from rimsight.llm.columns import doc_key, fresh
from rimsight.llm.queries_tokens import word_tokenizer
from rimsight.llm.shared import held
from rimsight.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's calibrated threshold; the classifier learns from the stage's own input.

    Null and empty texts are scored as empty ones, a null language has the common threshold,
    repeated rows are judged each. Columns of any further name stay, also ones named as the score.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (score,) = fresh(docs, "toxicity_score")
    scored = toxicity.with_scores(docs, model, score=score)
    return scored.filter(F.col(score) < toxicity.threshold(model, F.col("lang"))).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near duplicates; texts without words are no group.

    A null id counts as the smallest, rows that share an id are one document and stay
    together. Columns of any further name stay.
    """
    (kept_id,) = fresh(docs, "kept_doc")
    kept = near_join.classes(docs).filter("doc = component").select(F.col("doc").alias(kept_id)).distinct()
    return docs.join(kept.hint("shuffle_hash"), doc_key("doc_id") == F.col(kept_id), "left_semi")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item, with an id or without; null and empty texts hold none."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"), unnamed=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice stands twice, null is a source of its own, empty texts are never taken."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id shards in the shared folder, and what they hold of each document; null texts are empty, null ids come first."""
    return token_files.read_shards(token_files.write_shards(docs, scratch_path(spark, "pipeline-shards"), word_tokenizer()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_output", token_output),
]

# Training, tokenizing and files are beyond SQL: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
