"""Tables that change and what is kept beside them: versioned upserts, live counts, late rows,
user bitmaps, ranked pages and the search dictionary. Each key builds its table from all events
and reads the result back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.catalog import register
from adoptlens.catalog.adoption_q import kpis_sql
from adoptlens.catalog.dashboard_q import KPIS_SQL, PAGE_COLS_SQL
from adoptlens.operators.enrich import enrich_usage, normalize_events
from adoptlens.operators.filters import Filters
from adoptlens.operators.upsert import upsert_into_table
from adoptlens.operators.versions import read_table
from adoptlens.plans import bitmaps, pages, search
from adoptlens.session import scratch_path
from adoptlens.sources import fixtures as fx
from adoptlens.sources.tables import table
from adoptlens.streaming import ingest as S
from adoptlens.streaming import live

W = fx.with_fixtures


def _id():
    return F.col("usage_id").cast("long")


def _no_day():
    return F.lit(None).cast("date")


def _upsert(spark, path, rows):
    return upsert_into_table(spark, path, rows, ["usage_id"], ["utc_time"], "usage_date", cluster_by=["practice", "team"])


@register("upsert_null_dates", W("""
SELECT usage_id, user_email,
       CASE WHEN CAST(usage_id AS BIGINT) % 11 = 0 AND CAST(usage_id AS BIGINT) % 7 <> 0 THEN NULL ELSE usage_date END AS usage_date
FROM usage"""))
def q_upsert_null_dates(spark, sf):
    """Every seventh event is stored without a day and gets one; every eleventh of the others loses its day."""
    path, usage = scratch_path(spark, "null-dates"), fx.usage(spark, sf)
    seventh, eleventh = _id() % 7 == 0, _id() % 11 == 0
    _upsert(spark, path, usage.withColumn("usage_date", F.when(seventh, _no_day()).otherwise(F.col("usage_date"))))
    _upsert(spark, path, usage.where(seventh | eleventh).withColumn("usage_date", F.when(~seventh, _no_day()).otherwise(F.col("usage_date"))))
    return read_table(spark, path).select("usage_id", "user_email", "usage_date")


@register("upsert_moved_date", W("""
SELECT usage_id, CASE WHEN CAST(usage_id AS BIGINT) % 5 = 0 THEN usage_date + CAST(CAST(usage_id AS BIGINT) % 3 AS INTEGER) ELSE usage_date END AS usage_date,
       CASE WHEN CAST(usage_id AS BIGINT) % 5 = 0 THEN 'corrected' ELSE access_point END AS access_point
FROM usage"""))
def q_upsert_moved_date(spark, sf):
    """Every fifth event comes again, corrected, on its day or one of the two after it."""
    path, usage = scratch_path(spark, "moved-date"), fx.usage(spark, sf)
    _upsert(spark, path, usage)
    moved = usage.where(_id() % 5 == 0).withColumns({"usage_date": F.date_add("usage_date", (_id() % 3).cast("int")), "access_point": F.lit("corrected")})
    _upsert(spark, path, moved)
    return read_table(spark, path).select("usage_id", "usage_date", "access_point")


# --- streams ---------------------------------------------------------------------------

_DIMS = ["practice", "team", "location", "designation", "access_point"]


def _landed(spark, sf, folder: str, part) -> None:
    """Events of one delivery, as files of a landing folder."""
    table(spark, sf, "events").where(part).write.mode("append").parquet(folder)


def _events(spark, sf, folder: str) -> DataFrame:
    """The landing folder as a stream of enriched events."""
    raw = spark.readStream.schema(table(spark, sf, "events").schema).parquet(folder)
    eid = F.col("event_id")
    raw = raw.select(eid.cast("string").alias("usage_id"), F.col("ts").alias("utc_time"), fx.event_user(F.col("user_id")).alias("user"),
                     F.col("event_type").alias("access_point"), fx.product_area_expr(eid).alias("product_area"), (eid % 4).cast("int").alias("file_count"))
    return enrich_usage(normalize_events(raw), fx.roster(spark, sf))


@register("stream_dimension_counts", W("\nUNION ALL ".join(
    f"SELECT '{d}' AS dimension, COALESCE({d}, 'Unknown') AS label, usage_date AS day, COUNT(*) AS events FROM usage WHERE usage_date IS NOT NULL GROUP BY 2, 3"
    for d in _DIMS)))
def q_stream_dimension_counts(spark, sf):
    """Three deliveries of events that share their days; each merges the groups it changed."""
    base = scratch_path(spark, "live-counts")
    for k in range(3):
        _landed(spark, sf, f"{base}/landing", F.col("event_id") % 3 == k)
        events = _events(spark, sf, f"{base}/landing").withColumn("event_ts", S.event_instant(spark, "utc_time"))
        counts = live.dimension_counts(events, "event_ts", _DIMS, delay="60 days")
        live.keep_dimension_counts(counts, f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return read_table(spark, f"{base}/counts").select("dimension", "label", "day", "events")


#: Delivery of an event: by thirds of the month, every fifth one delivery later.
_DELIVERY_SQL = "least(2, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END)"


@register("stream_late_rows", f"""
WITH e AS (SELECT CAST(event_id AS VARCHAR) AS usage_id, ts, CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date, {_DELIVERY_SQL} AS delivery FROM events),
top AS (SELECT delivery, max(ts) - INTERVAL 2 DAY AS t FROM e GROUP BY delivery),
behind AS (SELECT d.delivery, max(top.t) AS t FROM (SELECT DISTINCT delivery FROM e) d JOIN top ON top.delivery < d.delivery GROUP BY d.delivery)
SELECT usage_id, usage_date, CASE WHEN e.ts < behind.t THEN 'back-fill' ELSE 'stream' END AS arrived FROM e LEFT JOIN behind USING (delivery)""")
def q_stream_late_rows(spark, sf):
    """Three deliveries with a watermark of two days; what lies behind it is back-filled, once."""
    base = scratch_path(spark, "late-rows")
    ts, eid = F.col("ts"), F.col("event_id")
    third = F.when(ts < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(ts < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(2)
    delivery = F.least(F.lit(2), third + F.when(eid % 5 == 0, 1).otherwise(0))
    where = {"table_path": f"{base}/table", "queue_path": f"{base}/queue"}
    for k in range(3):
        _landed(spark, sf, f"{base}/landing", delivery == k)
        rows = _events(spark, sf, f"{base}/landing").withColumn("arrived", F.lit("stream"))
        live.ingest_on_time(rows, checkpoint=f"{base}/checkpoint", delay=dt.timedelta(days=2), **where).awaitTermination()
    for _ in range(2):  # the second time finds nothing
        live.backfill_late(spark, prepare=lambda rows: rows.withColumn("arrived", F.lit("back-fill")), **where)
    return read_table(spark, f"{base}/table").select("usage_id", "usage_date", "arrived")


# --- bitmaps ---------------------------------------------------------------------------

_WINDOWS = {"all": (None, None), "days": ("2024-01-10", "2024-01-20"), "one": ("2024-01-15", "2024-01-15")}


def _dates_sql(start, end) -> str:
    return f"usage_date >= DATE '{start}' AND usage_date <= DATE '{end}'" if start else "TRUE"


def _windows_sql(one) -> str:
    return "\nUNION ALL ".join(f"SELECT '{name}' AS win, * FROM ({one(_dates_sql(*dates))})" for name, dates in _WINDOWS.items())


def _over_windows(one) -> DataFrame:
    return reduce(DataFrame.unionByName, [one(*dates).withColumn("win", F.lit(name)) for name, dates in _WINDOWS.items()])


def _bitmaps(spark, sf) -> str:
    path = scratch_path(spark, "bitmaps")
    bitmaps.refresh(spark, fx.usage(spark, sf), fx.roster(spark, sf), path)
    return path


@register("bitmap_dashboard_kpis", _windows_sql(lambda dates: W(KPIS_SQL.format(where=f"WHERE {dates} AND access_point <> 'purchase'"))))
def q_bitmap_dashboard_kpis(spark, sf):
    """Dashboard KPIs of three windows under a selection, from bitmaps."""
    path = _bitmaps(spark, sf)
    kinds = [r[0] for r in table(spark, sf, "events").select("event_type").distinct().collect() if r[0] not in (None, "purchase")]
    return _over_windows(lambda s, e: bitmaps.dashboard_kpis(spark, path, Filters(accesses=kinds, start_date=s, end_date=e)))


@register("bitmap_adoption_kpis", _windows_sql(lambda dates: kpis_sql("designation IN ('Associate', 'Partner')", dates)))
def q_bitmap_adoption_kpis(spark, sf):
    """Adoption KPIs of three windows under a selection, from bitmaps."""
    path = _bitmaps(spark, sf)
    return _over_windows(lambda s, e: bitmaps.adoption_kpis(spark, path, Filters(designations=["Associate", "Partner"], start_date=s, end_date=e)))


# --- pages and search ------------------------------------------------------------------

@register("usage_page_deep", W(f"""
SELECT {PAGE_COLS_SQL} FROM (
  SELECT *, row_number() OVER (ORDER BY location DESC NULLS LAST, usage_id) - 1 AS place, COUNT(*) OVER () AS total FROM usage)
WHERE place // 20 = (total * 95 // 100) // 20"""))
def q_usage_page_deep(spark, sf):
    """The page that holds the row at 95 of 100, from a copy in ranges."""
    path = scratch_path(spark, "ranked")
    pages.write_ranked(fx.usage(spark, sf), path, "Location", range_rows=2000)
    page = pages.total(spark, path) * 95 // 100 // 20 + 1
    return pages.ranked_page(spark, path, None, "Location", False, page).select(*[c.strip() for c in PAGE_COLS_SQL.split(",")])


_NEEDLES = ["  NaTion_1 ", "MER#0000", "us", "7", "\\_", "r%0001", "work"]


def _needle_sql(needle: str) -> str:
    pattern = f"'%{needle.strip().lower()}%' ESCAPE '\\'"
    return " OR ".join(f"lower(coalesce({c}, '')) LIKE {pattern}" for c in search.SEARCH_COLUMNS)


@register("search_usage_indexed", W("\nUNION ALL ".join(f"SELECT '{n}' AS needle, usage_id, user_email, location FROM usage WHERE {_needle_sql(n)}" for n in _NEEDLES)))
def q_search_usage_indexed(spark, sf):
    """Needles of one, two and many characters, with wildcards and an escaped one, through the dictionary."""
    path, usage = scratch_path(spark, "search"), fx.usage(spark, sf)
    search.refresh(usage, path)
    found = [search.search(usage, path, n).select(F.lit(n).alias("needle"), "usage_id", "user_email", "location") for n in _NEEDLES]
    return reduce(DataFrame.unionByName, found)
