"""Operators of a training-data pipeline, each a function from DataFrame to DataFrame.

Nothing else in the library imports this package. `registry.py` holds its queries
and their DuckDB twins.
"""
