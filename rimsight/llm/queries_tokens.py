"""op8: all documents as token-id files, read back."""

from __future__ import annotations

from rimsight.llm import token_files
from rimsight.llm.registry import query
from rimsight.session import scratch_path


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_token_files")
def op8_token_files(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_files.read_shards(token_files.write_shards(docs, scratch_path(spark, "token-shards"), word_tokenizer()))
