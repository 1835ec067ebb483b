"""Operators applied to the shared test tables, each with the SQL that must give the same rows."""

from riskflow.queries import cleaning, dataset, gold, joins, labels, metrics, models, pit, profiles, profiling, stores  # noqa: F401
from riskflow.queries.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
