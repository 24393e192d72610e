"""Local-calendar arithmetic: UTC instants <-> local days, windows and back-fill chunks."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference's pipeline.
DEFAULT_TZ = "Asia/Kolkata"
MAX_RANGE_DAYS = 30


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_wallclock(utc_ts: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Local wall-clock time (TIMESTAMP_NTZ) of a UTC instant (NTZ or LTZ column)."""
    ts = _col(utc_ts).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)


def local_date(utc_ts: Column | str, tz: str = DEFAULT_TZ) -> Column:
    return F.to_date(local_wallclock(utc_ts, tz))


def local_hour(utc_ts: Column | str, tz: str = DEFAULT_TZ) -> Column:
    return F.hour(local_wallclock(utc_ts, tz))


def parse_utc_text(c: Column | str) -> Column:
    """Lenient parse of ISO-8601 event time text to UTC NTZ; text without an offset is UTC.

    The wall clock and the offset ('Z', '+05:30', '-0800', '+05') are read apart, so the
    result does not depend on the session zone. An offset counts only after a time of day.
    """
    s = F.trim(_col(c))
    pattern = r"^(.*:\d{2}(?:\.\d*)?|.*[T ]\d{1,2})\s*([+-])(\d{2}):?(\d{2})?$"
    plain = F.regexp_replace(s, r"\s*[Zz]$", "")
    wall = F.when(plain.rlike(pattern), F.regexp_extract(plain, pattern, 1)).otherwise(plain)
    part = lambda i: F.coalesce(F.regexp_extract(plain, pattern, i).try_cast("int"), F.lit(0))
    minutes = F.when(F.regexp_extract(plain, pattern, 2) == "-", -1).otherwise(1) * (part(3) * 60 + part(4))
    utc = wall.try_cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", -minutes, utc).cast("timestamp_ntz")


def local_midnight_utc(day: str | dt.date, tz: str = DEFAULT_TZ) -> dt.datetime:
    """UTC wall time (naive) of local midnight of ``day``."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    local = dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz))
    return local.astimezone(dt.timezone.utc).replace(tzinfo=None)


def month_window(month: str) -> tuple[dt.date, dt.date]:
    """'YYYY-MM' -> (first day, first day of next month) — end exclusive."""
    y, m = map(int, month.split("-"))
    start = dt.date(y, m, 1)
    end = dt.date(y + (m == 12), 1 if m == 12 else m + 1, 1)
    return start, end


def day_window(day: str) -> tuple[dt.date, dt.date]:
    d = dt.date.fromisoformat(day)
    return d, d + dt.timedelta(days=1)


def yesterday_window(tz: str = DEFAULT_TZ, now: dt.datetime | None = None) -> tuple[dt.date, dt.date]:
    now = now or dt.datetime.now(ZoneInfo(tz))
    y = (now.astimezone(ZoneInfo(tz)) - dt.timedelta(days=1)).date()
    return y, y + dt.timedelta(days=1)


def resolve_window(*, month: str | None = None, day: str | None = None,
                   start: str | None = None, end: str | None = None,
                   tz: str = DEFAULT_TZ) -> tuple[dt.date, dt.date]:
    """Local-day window [start, end) in the four modes: month, day, range, yesterday."""
    if month:
        if day or start or end:
            raise ValueError("use month alone, or day, or start/end")
        return month_window(month)
    if day:
        if start or end:
            raise ValueError("use either day or start/end, not both")
        return day_window(day)
    if start or end:
        if not (start and end):
            raise ValueError("start and end must be used together")
        return dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return yesterday_window(tz)


def window_predicate(utc_ts: Column | str, start: dt.date | str, end: dt.date | str,
                     tz: str = DEFAULT_TZ) -> Column:
    """Instant predicate for local days [start, end) on the raw timestamp.

    Written on the stored column itself so the Parquet reader receives it as a pushed
    filter (row-group min/max skipping); a predicate on a derived local date is not pushed.
    """
    lo = local_midnight_utc(start, tz)
    hi = local_midnight_utc(end, tz)
    ts = _col(utc_ts)
    return (ts >= utc_literal(lo)) & (ts < utc_literal(hi))


def utc_literal(when: dt.datetime, dtype="timestamp_ntz") -> Column:
    """Literal for a naive UTC wall time, independent of the session and process zones."""
    text = when.strftime("%Y-%m-%d %H:%M:%S.%f")
    if str(dtype).lower().startswith("timestamp_ntz") or "NTZ" in str(dtype):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "Z").cast("timestamp")


def backfill_chunks(spark: SparkSession, start: str, end: str,
                    max_days: int = MAX_RANGE_DAYS, tz: str = DEFAULT_TZ) -> DataFrame:
    """Plan of <= max_days local-day chunks covering [start, end) with their UTC bounds."""
    s = F.lit(start).cast("date")
    e = F.lit(end).cast("date")
    plan = spark.range(1).select(
        F.explode(F.sequence(s, F.date_sub(e, 1), F.expr(f"INTERVAL {int(max_days)} DAYS"))).alias("chunk_start")
    )
    plan = plan.withColumn("chunk_end", F.least(F.date_add("chunk_start", int(max_days)), e))
    to_utc = lambda c: F.convert_timezone(F.lit(tz), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
    return plan.select(
        "chunk_start", "chunk_end",
        to_utc("chunk_start").alias("utc_start"),
        to_utc("chunk_end").alias("utc_end"),
        F.datediff("chunk_end", "chunk_start").alias("days"),
    )


def archive_label(start: str, end: str) -> str:
    """Label of an archive chunk: start … inclusive end."""
    end_incl = dt.date.fromisoformat(end) - dt.timedelta(days=1)
    return f"usage_enriched_{start}_to_{end_incl.isoformat()}"
