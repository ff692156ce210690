"""Relational operators over entity DataFrames."""
