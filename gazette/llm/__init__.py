"""Operators for large training corpora, and the queries that apply them."""

from gazette.llm.registry import ORACLES, QUERIES
from gazette.llm import queries  # noqa: F401  registers the queries

__all__ = ["ORACLES", "QUERIES"]
