"""Registered queries: each key has a Spark plan and (when SQL can express it) a DuckDB oracle.

The Spark callables take ``(spark, sf_dir)`` and read the driver tables; the oracle SQL
runs on the same tables as DuckDB views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a Spark query under ``name`` with its oracle statement."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module so their registrations run."""
    from adoptlens.catalog import (  # noqa: F401
        adoption_q,
        bundle_q,
        dashboard_q,
        ingest_q,
        jobs_q,
        merge_q,
        reconcile_q,
        report_q,
        reports_q,
        rollup_q,
        stream_q,
        tables_q,
    )
