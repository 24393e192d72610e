"""Sync bookkeeping: dataset metadata and back-fill plans.

Both read the large usage table once into per-day counts (one row per calendar day) and
finish on that small frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ, MAX_RANGE_DAYS
from adoptlens.plans.rollup import rows


def _per_day(usage: DataFrame) -> DataFrame:
    return usage.groupBy(F.col("usage_date").alias("day")).agg(rows(usage).alias("cnt"))


def sync_metadata(usage: DataFrame, last_sync_rows: int | None = None) -> DataFrame:
    """row_count, min_date, max_date and rows of the last sync (default: rows on the last day).

    The true maximum date is used (NULL dates never win).
    """
    d = _per_day(usage)
    b = d.agg(F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("row_count"), F.min("day").alias("min_date"),
              F.max("day").alias("max_date"))
    if last_sync_rows is not None:
        return b.withColumn("last_sync_rows", F.lit(int(last_sync_rows)).cast("bigint"))
    last = d.join(F.broadcast(b.select("max_date")), F.col("day") == F.col("max_date")).agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("last_sync_rows"))
    return b.crossJoin(last)  # one row x one row


def backfill_plan(usage: DataFrame, max_days: int = MAX_RANGE_DAYS, tz: str = DEFAULT_TZ) -> DataFrame:
    """Split the data's local-day range [first day, last day + 1) into <= max_days chunks,
    with UTC bounds for each fetch and the events already stored per chunk."""
    d = _per_day(usage).filter(F.col("day").isNotNull())
    b = d.agg(F.min("day").alias("s"), F.date_add(F.max("day"), 1).alias("e"))
    step = F.expr(f"INTERVAL {int(max_days)} DAYS")
    chunks = b.select("s", "e", F.explode(F.sequence("s", F.date_sub("e", 1), step)).alias("chunk_start"))
    chunks = chunks.select(
        "chunk_start",
        F.least(F.date_add("chunk_start", int(max_days)), F.col("e")).alias("chunk_end"),
        F.floor(F.datediff("chunk_start", "s") / int(max_days)).cast("bigint").alias("idx"),
    )
    per_chunk = d.crossJoin(F.broadcast(b)).groupBy(
        F.floor(F.datediff("day", "s") / int(max_days)).cast("bigint").alias("idx")
    ).agg(F.sum("cnt").cast("bigint").alias("events"))
    to_utc = lambda c: F.convert_timezone(F.lit(tz), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
    return chunks.join(per_chunk, "idx", "left").select(
        "chunk_start", "chunk_end", to_utc("chunk_start").alias("utc_start"), to_utc("chunk_end").alias("utc_end"),
        F.coalesce(F.col("events"), F.lit(0)).cast("bigint").alias("events"),
    ).orderBy("chunk_start")
