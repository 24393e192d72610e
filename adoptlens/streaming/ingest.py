"""Structured Streaming twins of the daily sync.

* ``ingest``: new event files -> clean -> enrich -> per-micro-batch keyed upsert into the
  date-partitioned usage table (idempotent: re-delivered files and overlapping fetches
  land on the same keys). Run with ``trigger(availableNow=True)`` as the scheduled job.
* ``dedupe_stream``: overlap/retry de-duplication by id inside an event-time watermark.
* ``daily_counts``: running per-local-day counts (tumbling windows aligned to local
  midnight through the window start offset).

Event time must be a TIMESTAMP (instant) column for watermarks; ``event_instant``
converts the stored UTC wall time explicitly.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ
from adoptlens.operators.upsert import read_table, upsert_into_table
from adoptlens.plans.sync import sync_metadata


def event_instant(spark: SparkSession, ntz_utc: Column | str) -> Column:
    """UTC wall time (TIMESTAMP_NTZ) -> TIMESTAMP instant, whatever the session zone."""
    c = F.col(ntz_utc) if isinstance(ntz_utc, str) else ntz_utc
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    # UTC wall clock -> session-zone wall clock, which the cast reads back as the instant
    return F.convert_timezone(F.lit("UTC"), F.lit(session_tz), c.cast("timestamp_ntz")).cast("timestamp")


def local_midnight_offset(tz: str = DEFAULT_TZ) -> str:
    """Window start offset that aligns 1-day windows with local midnight (fixed-offset zones)."""
    off = dt.datetime(2024, 1, 1, tzinfo=ZoneInfo(tz)).utcoffset() or dt.timedelta(0)
    minutes = int((-off).total_seconds() // 60) % (24 * 60)
    return f"{minutes // 60} hours {minutes % 60} minutes"


def ingest(batch_rows: DataFrame, table_path: str, checkpoint: str, keys=("usage_id",),
           order_cols=("utc_time",), partition_col: str = "usage_date", trigger_once: bool = True):
    """Start the ingest query: each micro-batch is upserted into the table at ``table_path``."""
    spark = batch_rows.sparkSession

    def merge_batch(df: DataFrame, batch_id: int) -> None:
        upsert_into_table(spark, table_path, df, list(keys), list(order_cols), partition_col,
                          cluster_by=[c for c in ("practice", "team", "user_email") if c in df.columns])

    writer = batch_rows.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()


def dedupe_stream(events: DataFrame, id_col: str, time_col: str, delay: str = "1 day") -> DataFrame:
    """Drop repeated ids within the watermark delay (first arrival kept)."""
    return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def has_fixed_offset(tz: str) -> bool:
    z = ZoneInfo(tz)
    return len({dt.datetime(2024, m, 15, tzinfo=z).utcoffset() for m in (1, 4, 7, 10)}) == 1


def daily_counts(events: DataFrame, time_col: str, tz: str = DEFAULT_TZ, delay: str = "1 day") -> DataFrame:
    """Events per local calendar day as a running aggregate.

    Fixed-offset zones use 1-day event-time windows shifted to local midnight (so append
    mode and watermark state eviction work). Zones with daylight saving have 23/25-hour
    days that no fixed window matches: they group by the computed local date instead
    (update/complete mode).
    """
    session_tz = events.sparkSession.conf.get("spark.sql.session.timeZone")
    if not has_fixed_offset(tz):
        local = F.convert_timezone(F.lit(session_tz), F.lit(tz), F.col(time_col).cast("timestamp_ntz"))
        return (events.withWatermark(time_col, delay).groupBy(F.to_date(local).alias("usage_date"))
                .agg(F.count(F.lit(1)).alias("events")))
    w = F.window(time_col, "1 day", "1 day", local_midnight_offset(tz))
    g = events.withWatermark(time_col, delay).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("events"))
    # instant -> wall clock of the session zone -> wall clock of the local zone
    local_start = F.convert_timezone(F.lit(session_tz), F.lit(tz), F.col("w.start").cast("timestamp_ntz"))
    return g.select(F.to_date(local_start).alias("usage_date"), "events")


def write_complete(agg: DataFrame, out_path: str, checkpoint: str):
    """Complete-mode aggregate rewritten as a Parquet table on every trigger."""

    def overwrite(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(out_path)

    return (agg.writeStream.outputMode("complete").foreachBatch(overwrite)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def refresh_metadata(spark: SparkSession, table_path: str, meta_path: str, last_sync_rows: int | None = None) -> None:
    """Metadata step run after the stream, also when it brought no new rows."""
    sync_metadata(read_table(spark, table_path), last_sync_rows).write.mode("overwrite").parquet(meta_path)


def ingest_documents(spark: SparkSession, landing_dir: str, roster: DataFrame, table_path: str,
                     checkpoint: str, tz: str = DEFAULT_TZ, trigger_once: bool = True):
    """Landed event documents -> flatten -> clean -> roster join (stream-static) -> upsert.

    New files in ``landing_dir`` are picked up once each (checkpointed); a file delivered
    twice, or overlapping fetch windows, land on the same keys.
    """
    from adoptlens.operators.enrich import enrich_usage, normalize_events
    from adoptlens.sources.events_json import flatten, read_documents_stream, to_usage_events

    events = normalize_events(to_usage_events(flatten(read_documents_stream(spark, landing_dir), tz)), tz)
    rows = enrich_usage(events, roster)
    return ingest(rows, table_path, checkpoint, trigger_once=trigger_once)
