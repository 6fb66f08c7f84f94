"""Queries over the benchmark tables and their SQL twins."""
