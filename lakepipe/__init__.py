"""Layered data pipelines on Spark, driven by declarations.

Every operator takes and returns DataFrames; nothing here collects data rows
to the driver or runs per-row Python.
"""
