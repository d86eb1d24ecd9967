"""Queries that exercise every operator on the test tables, and their SQL twins."""
