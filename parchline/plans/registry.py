"""Name to builder, name to SQL."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under a name, with its SQL twin if it has one."""

    def register(builder: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = builder
        if sql is not None:
            ORACLE[name] = sql.strip()
        return builder

    return register


def load() -> None:
    """Import every module that registers queries."""
    from . import capture, cost, evaluate, gold, lifecycle, monitor, search, silver, streams  # noqa: F401
