"""Operators for preparing training data at scale.

Each module holds one operator that takes and returns DataFrames;
``queries`` applies them to the driver tables and ``oracle_sql`` holds the
DuckDB twins of those that SQL can express.  Nothing outside this subpackage
imports it.
"""
