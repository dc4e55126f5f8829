"""Joins, rollups, checks and record repair."""
