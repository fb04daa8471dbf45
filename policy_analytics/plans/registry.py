"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)``, reads the fixture views of the given tables and
returns a lazy DataFrame. Modules under ``plans`` register their queries on import.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, oracle: str | None = None, headline: bool = False):
    """Decorator: register ``fn`` as query ``name`` with its oracle SQL."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from . import analytics, cleaning, quality, rates, store, timeseries  # noqa: F401
