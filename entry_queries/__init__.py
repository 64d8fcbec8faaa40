"""Queries over the given tables, one per operator, each with an equivalent DuckDB statement.

Every module fills ``QUERIES``: name -> (callable(spark, sf_dir), SQL text or None).
"""
