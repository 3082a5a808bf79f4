"""Named queries: each pairs a Spark callable (spark, sf_dir) -> DataFrame with
its DuckDB oracle SQL (or None when only a rows check is possible).

Query bodies live in ``gearwatch.plans``; this module only collects them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, str] = {}  # query name -> SURVEY §2 operator ids it covers


def register(name: str, oracle: str | None = None, covers: str = ""):
    """Decorator: register a query under ``name`` with optional oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        OPERATORS[name] = covers
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from .plans import (dashboard, daily_job, knowledge, medallion, metric_views,  # noqa: F401
                        modeling, questions, streaming_twins, tables)
