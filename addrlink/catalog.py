"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads whole tables (no id subsets, no row caps) and returns a
DataFrame whose computed columns are aliased exactly like the oracle's.
Queries are grouped by the SURVEY §7.3 map; the operators they exercise are
named in each docstring.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from .plans import (q_labels, q_matching, q_relational,  # noqa: F401
                        q_housenumbers, q_exports, q_prepare, q_register, q_sources)
