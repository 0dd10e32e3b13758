"""Operators for preparing language-model training data.

Nothing outside this folder imports it.  Each module holds one operator with
its general interface; ``catalog`` holds the registered queries and their
DuckDB statements.
"""
