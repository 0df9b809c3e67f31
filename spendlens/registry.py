"""Registered queries: one per operator group of the survey, each a Spark
DataFrame over the driver tables plus (where SQL can state it) the DuckDB
oracle text.  ``__spark_entry__`` exposes these to the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load() -> None:
    """Import the modules that register queries."""
    from . import queries  # noqa: F401
