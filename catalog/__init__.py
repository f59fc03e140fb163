"""Registered queries: every operator run over the test tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` with, where SQL can
express it, an independent SQL statement giving the same rows.
"""
