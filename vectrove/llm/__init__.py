"""Operators for preparing training text, beside the vector operators of the library.

Nothing else in the library imports this package. Queries over the given tables are in
:mod:`vectrove.llm.queries`.
"""
