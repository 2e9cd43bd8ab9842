"""All queries of this subpackage."""

from rimsight.llm import (  # noqa: F401
    queries_decontaminate,
    queries_lines,
    queries_mixing,
    queries_near,
    queries_quality,
    queries_ranked,
    queries_repair,
    queries_search,
    queries_suffix,
    queries_tokens,
    queries_toxicity,
    queries_warc,
)
from rimsight.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
