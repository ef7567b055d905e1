"""Runs every operator over the given tables: views, queries and their SQL twins."""
