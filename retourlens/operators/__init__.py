"""Relational, model and decision operators on DataFrames."""
