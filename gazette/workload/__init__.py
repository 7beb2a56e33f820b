"""The operators applied to the test tables, each query beside its SQL equivalent."""

from gazette.workload import articles, enrichment, feeds, gate, logs, metrics, search, upkeep
from gazette.workload.base import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "articles",
    "enrichment",
    "feeds",
    "gate",
    "logs",
    "metrics",
    "search",
    "upkeep",
]
