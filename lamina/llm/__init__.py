"""Operators of a training-data pipeline.

One module per operator; ``queries`` holds the registered queries and their DuckDB
SQL. Nothing else in the library imports this subpackage.
"""
