"""The registered queries: every operator over the given tables."""

from catalogue import clustering, models, scoring, shaping, statistics, storage  # noqa: F401
from catalogue.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
