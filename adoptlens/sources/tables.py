"""Readers for the driver's Parquet tables and for the engine's own stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Column pruning and filters reach the Parquet scan through Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail fast when a required input (e.g. the roster) is empty; one-row probe only."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
