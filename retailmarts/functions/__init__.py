"""Expressions for the jobs, as SQL text.

Each function takes and returns Spark SQL text: it composes by name, stays in the JVM, and a whole
projection is built with a handful of calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def columns(**expressions: str) -> list[Column]:
    """Named columns of SQL expressions, for ``select`` and ``agg``."""
    return [F.expr(f"{sql} AS {name}") for name, sql in expressions.items()]


def once(**expressions: str) -> Column:
    """A generator that computes the expressions exactly once per row.

    The optimiser copies a projected expression into every later filter that mentions it, and nested
    conditions then multiply.  It never copies what a generator produces.
    """
    fields = ", ".join(f"'{name}', {sql}" for name, sql in expressions.items())
    return F.expr(f"inline(array(named_struct({fields})))")
