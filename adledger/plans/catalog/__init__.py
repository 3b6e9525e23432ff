"""Registered queries: each runs one operator over the given tables, with an
independent SQL statement for the same answer where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aggregates, fields, landing, learning, relations, streams, texts, wholejobs

MODULES = [landing, relations, aggregates, fields, texts, learning, streams, wholejobs]
Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
