"""Named tables that are built when first asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


class Tables(dict[str, DataFrame]):
    """A dictionary of tables with a maker per name; only what is used is ever planned."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self.makers = makers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.makers[name]()
        return self[name]

    def pick(self, names) -> dict[str, DataFrame]:
        return {name: self[name] for name in names}
