"""The library's operators applied to the given tables, each with the SQL that must give the same rows.

Roles: an order is a checklist, a line item an observation, a customer a location (its nation the
subregion, its region the country), a part a species (its type the order, its brand the family). Purchases
are facts and views the weather answers of a user and day.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    for module in (
        "marks", "feed_checks", "dictionaries", "merges", "star", "weather_checks", "reporting", "storage", "streams",
    ):
        importlib.import_module(f"checks.{module}")
