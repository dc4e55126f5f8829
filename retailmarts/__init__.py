"""Retail data jobs on Spark: every transformation takes and returns DataFrames."""

from retailmarts.session import configure, session

__all__ = ["configure", "session"]
