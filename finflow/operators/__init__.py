"""Relational operators of the pipeline, each a composition of DataFrame operations."""
