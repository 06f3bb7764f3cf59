"""Whole runs, and the queries that exercise every operator on the benchmark tables."""
