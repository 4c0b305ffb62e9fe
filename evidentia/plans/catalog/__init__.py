"""Registry of queries: each one a plan over the given tables, with its check.

A module of this package fills ``Catalog`` instances; ``queries`` and
``checks`` merge them.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
FAMILIES = ("normalize", "extract", "resolve", "decide", "evaluate", "rank", "model", "fuzzy", "io", "scan", "full")


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.checks: dict[str, str] = {}

    def add(self, name: str, check: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} registered twice")
            self.queries[name] = query
            if check is not None:
                self.checks[name] = check
            return query

        return register


def _merged(part: str) -> dict:
    out: dict = {}
    for family in FAMILIES:
        out.update(getattr(import_module(f"{__name__}.{family}").catalog, part))
    return out


def queries() -> dict[str, Query]:
    return _merged("queries")


def checks() -> dict[str, str]:
    return _merged("checks")
