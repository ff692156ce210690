"""Readers and writers: CSV sources, partitioned tables, sinks, sample tables."""
