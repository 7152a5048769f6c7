"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage; ``llm.queries`` holds
the registered queries and ``llm.sql`` their DuckDB equivalents.
"""
