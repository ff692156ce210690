"""Tallyhouse: a PySpark-native retail analytics engine.

Raw CSV or Parquet comes in, every row is cleaned and checked, bad rows are
quarantined with a reason, good rows are merged into partitioned Parquet
tables, and reports are DataFrame queries over rollups of those tables.
"""
