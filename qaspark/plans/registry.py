"""Name -> query composition, and name -> DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame`` composed from the
operators on the supplied tables. ``sql`` is the independent DuckDB text
that must return the same rows; ``None`` marks a rows-only check."""

from __future__ import annotations

import functools
from collections.abc import Callable

from qaspark.session import ship_package

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            # the supplied event times are TIMESTAMP_NTZ; casts to TIMESTAMP
            # (watermarks, epoch arithmetic) read them as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco
