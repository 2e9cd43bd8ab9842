"""All registered queries."""

from rimsight.plans import q_box, q_careers, q_changes, q_crew, q_files, q_lookups, q_pages, q_plays, q_text  # noqa: F401
from rimsight.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
