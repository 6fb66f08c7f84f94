"""Readers, writers and the adapter view over the benchmark tables."""
