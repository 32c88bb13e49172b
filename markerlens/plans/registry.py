"""Registry of the named queries: a Spark builder and, where SQL can express it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, tuple[str, ...]] = {}


def register(name: str, operators: tuple[str, ...] = (), sql: str | None = None):
    """Decorator: ``@register("clean_corpus", ("FLT-1", "DED-1"), sql=...)``."""

    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATORS[name] = tuple(operators)
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco
