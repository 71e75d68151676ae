"""Clustering and classification of large tables of fixed-width numeric vectors, on Spark."""

from vectrove.session import attach

__all__ = ["attach"]
