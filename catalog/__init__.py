"""Queries over the driver tables, one per operator, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name; ``sql`` is its oracle."""

    def register(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    from catalog import (  # noqa: F401
        aggregates,
        clusters,
        enrichment,
        files,
        filters,
        jobs,
        ordering,
        rules,
        scalars,
    )
