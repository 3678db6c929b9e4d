"""Operators for cleaning and mixing large text corpora.

Nothing else in the library imports this subpackage. ``queries.QUERIES``
holds the registered queries and ``oracle.ORACLE_SQL`` their DuckDB SQL.
"""
