"""Ingest-path queries: cleaning, coercion, local calendar, enrichment, roster import."""

from __future__ import annotations

from pyspark.sql import functions as F

from adoptlens.catalog import register
from adoptlens.functions.calendar import local_date, window_predicate
from adoptlens.functions.coerce import day_first_date, lenient_date, lenient_int
from adoptlens.functions.text import clean_text, normalize_email
from adoptlens.operators import enrich as E
from adoptlens.operators import roster as R
from adoptlens.plans import sync as S
from adoptlens.sources import fixtures as fx
from adoptlens.sources.tables import table

W = fx.with_fixtures

DIRTY_VALUES = ["", "  Padded Value  ", None, "3.7", " 12 ", "25/12/2025", "2025-12-25"]


def _dirty(event_id):
    expr = F.lit(None).cast("string")
    for i, v in enumerate(DIRTY_VALUES):
        expr = F.when(event_id % 7 == i, F.lit(v).cast("string")).otherwise(expr)
    return expr


DIRTY_SQL = ("CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '  Padded Value  ' WHEN 2 THEN NULL "
             "WHEN 3 THEN '3.7' WHEN 4 THEN ' 12 ' WHEN 5 THEN '25/12/2025' ELSE '2025-12-25' END")


def _dirty_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id")
    return e.select(
        F.col("event_id").cast("string").alias("usage_id"),
        _dirty(F.col("event_id")).alias("raw"),
        F.concat(F.lit("  User"), F.col("user_id").cast("string"), F.lit("@Example.COM ")).alias("raw_email"),
    )


@register("clean_text", f"""
SELECT CAST(event_id AS VARCHAR) AS usage_id, NULLIF(trim({DIRTY_SQL}), '') AS cleaned,
       lower(NULLIF(trim('  User' || CAST(user_id AS VARCHAR) || '@Example.COM '), '')) AS email
FROM events""")
def q_clean_text(spark, sf):
    d = _dirty_events(spark, sf)
    return d.select("usage_id", clean_text("raw").alias("cleaned"), normalize_email("raw_email").alias("email"))


@register("coerce_fields", f"""
WITH d AS (SELECT CAST(event_id AS VARCHAR) AS usage_id, NULLIF(trim({DIRTY_SQL}), '') AS v FROM events)
SELECT usage_id,
  CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN TRY_CAST(v AS INTEGER) END AS as_int,
  COALESCE(CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN TRY_CAST(v AS INTEGER) END, 0) AS as_int_or_zero,
  CAST(COALESCE(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%m/%d/%Y'), try_strptime(v, '%d/%m/%Y')) AS DATE) AS as_date,
  CAST(COALESCE(try_strptime(v, '%d/%m/%Y'), try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%d-%m-%Y')) AS DATE) AS as_day_first_date
FROM d""")
def q_coerce_fields(spark, sf):
    d = _dirty_events(spark, sf)
    return d.select(
        "usage_id",
        lenient_int("raw").alias("as_int"),
        lenient_int("raw", default=0).alias("as_int_or_zero"),
        lenient_date("raw").alias("as_date"),
        day_first_date("raw").alias("as_day_first_date"),
    )


@register("drop_keyless", """
WITH raw AS (
  SELECT CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN '   ' ELSE ' ' || CAST(event_id AS VARCHAR) END AS usage_id,
         CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'User' || CAST(user_id AS VARCHAR) || '@example.com' END AS usr,
         ts
  FROM events
)
SELECT NULLIF(trim(usage_id), '') AS usage_id, lower(NULLIF(trim(usr), '')) AS user_email,
       CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date
FROM raw WHERE NULLIF(trim(usage_id), '') IS NOT NULL AND NULLIF(trim(usr), '') IS NOT NULL""")
def q_drop_keyless(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    eid = F.col("event_id")
    raw = e.select(
        F.when(eid % 9 == 0, F.lit("")).when(eid % 9 == 1, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), eid.cast("string"))).alias("usage_id"),
        F.when(eid % 11 == 0, F.lit(None).cast("string")).when(eid % 11 == 1, F.lit("  "))
        .otherwise(F.concat(F.lit("User"), F.col("user_id").cast("string"), F.lit("@example.com"))).alias("user"),
        F.col("ts").alias("utc_time"),
    )
    return E.normalize_events(raw).select("usage_id", "user_email", "usage_date")


@register("local_calendar", """
SELECT CAST(event_id AS VARCHAR) AS usage_id, ts AS utc_time,
       CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date,
       CAST(EXTRACT(HOUR FROM ts + INTERVAL '330' MINUTE) AS INT) AS usage_hour
FROM events""")
def q_local_calendar(spark, sf):
    u = fx.usage(spark, sf)
    return u.select("usage_id", "utc_time", "usage_date", "usage_hour")


@register("local_month_window", """
SELECT CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date, COUNT(*) AS events
FROM events WHERE ts >= TIMESTAMP '2023-12-31 18:30:00' AND ts < TIMESTAMP '2024-01-31 18:30:00'
GROUP BY 1""")
def q_local_month_window(spark, sf):
    from adoptlens.functions.calendar import month_window
    start, end = month_window("2024-01")
    e = table(spark, sf, "events").select("ts").filter(window_predicate("ts", start, end))
    return e.groupBy(local_date("ts").alias("usage_date")).agg(F.count(F.lit(1)).alias("events"))


@register("local_range_window", """
SELECT event_id, CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date
FROM events WHERE ts >= TIMESTAMP '2024-01-09 18:30:00' AND ts < TIMESTAMP '2024-01-19 18:30:00'""")
def q_local_range_window(spark, sf):
    """Local days that cut the events on both sides, at 18:30 UTC."""
    from adoptlens.functions.calendar import resolve_window
    start, end = resolve_window(start="2024-01-10", end="2024-01-20")
    e = table(spark, sf, "events").select("event_id", "ts").filter(window_predicate("ts", start, end))
    return e.select("event_id", local_date("ts").alias("usage_date"))


@register("parse_offset_times", """
SELECT event_id, ts AS utc_time FROM events""")
def q_parse_offset_times(spark, sf):
    """Event times as text in seven notations, read back to UTC."""
    from adoptlens.functions.calendar import parse_utc_text
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    notations = [(0, "'Z'"), (330, "'+05:30'"), (-480, "'-08:00'"), (60, "'+0100'"), (-180, "'-03'"), (0, "'+00:00'"), (0, "''")]
    text = F.lit(None).cast("string")
    for i, (minutes, mark) in enumerate(notations):
        wall = F.date_format(F.timestamp_add("MINUTE", F.lit(minutes), F.col("ts")), f"yyyy-MM-dd{chr(39)}T{chr(39)}HH:mm:ss.SSSSSS{mark}" if mark != "''" else "yyyy-MM-dd HH:mm:ss.SSSSSS")
        text = F.when(F.col("event_id") % 7 == i, wall).otherwise(text)
    return e.select("event_id", parse_utc_text(text).alias("utc_time"))


@register("coerce_dates_general", """
WITH d AS (SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL)
SELECT event_id, day AS as_date,
       CASE WHEN event_id % 6 = 3 AND day(day) > 12 THEN NULL
            WHEN event_id % 6 = 3 THEN make_date(year(day), day(day), month(day)) ELSE day END AS as_day_first_date FROM d""")
def q_coerce_dates_general(spark, sf):
    """Dates with times, without leading zeros and with month names."""
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts")).filter("ts IS NOT NULL")
    text = F.lit(None).cast("string")
    for i, layout in enumerate(["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-M-d", "M/d/yyyy", "d MMM yyyy", "MMMM d, yyyy"]):
        text = F.when(F.col("event_id") % 6 == i, F.date_format("ts", layout)).otherwise(text)
    return e.select("event_id", lenient_date(text).alias("as_date"), day_first_date(text).alias("as_day_first_date"))


@register("backfill_chunks", """
WITH d AS (SELECT CAST(ts + INTERVAL '330' MINUTE AS DATE) AS day FROM events WHERE ts IS NOT NULL),
b AS (SELECT MIN(day) AS s, MAX(day) + 1 AS e FROM d),
c AS (
  SELECT CAST(g.chunk_start AS DATE) AS chunk_start FROM b,
    generate_series(CAST(b.s AS TIMESTAMP), CAST(b.e - 1 AS TIMESTAMP), INTERVAL 7 DAY) AS g(chunk_start)
),
n AS (SELECT CAST(date_diff('day', b.s, d.day) // 7 AS BIGINT) AS idx, COUNT(*) AS events FROM d, b GROUP BY 1)
SELECT c.chunk_start, LEAST(c.chunk_start + 7, b.e) AS chunk_end,
       CAST(c.chunk_start AS TIMESTAMP) - INTERVAL '330' MINUTE AS utc_start,
       CAST(LEAST(c.chunk_start + 7, b.e) AS TIMESTAMP) - INTERVAL '330' MINUTE AS utc_end,
       COALESCE(n.events, 0) AS events
FROM c CROSS JOIN b LEFT JOIN n ON n.idx = CAST(date_diff('day', b.s, c.chunk_start) // 7 AS BIGINT)""")
def q_backfill_chunks(spark, sf):
    return S.backfill_plan(fx.usage(spark, sf), max_days=7)


@register("file_list_stats", """
WITH f AS (
  SELECT CAST(event_id AS VARCHAR) AS usage_id,
    CASE WHEN event_id % 10 = 9 THEN NULL
         ELSE list_transform(list_filter(range(0, 4), lambda i: i < event_id % 4),
                             lambda i: 'f' || CAST(event_id AS VARCHAR) || '-' || CAST(i AS VARCHAR)) END AS file_ids
  FROM events
)
SELECT usage_id, CAST(COALESCE(len(file_ids), 0) AS INT) AS file_count, array_to_string(file_ids, ';') AS file_ids_text
FROM f""")
def q_file_list_stats(spark, sf):
    e = table(spark, sf, "events").select("event_id")
    eid = F.col("event_id")
    ids = F.when(eid % 10 == 9, F.lit(None)).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long")), lambda i: i < eid % 4),
                    lambda i: F.concat(F.lit("f"), eid.cast("string"), F.lit("-"), i.cast("string"))))
    from adoptlens.sources.events_json import file_stats
    return file_stats(e.select(eid.cast("string").alias("usage_id"), ids.alias("file_ids")))


@register("access_state", W("SELECT email, raw_status, access_state FROM roster", usage_needed=False))
def q_access_state(spark, sf):
    return fx.roster(spark, sf).select("email", "raw_status", "access_state")


@register("roster_state_counts", W("""
SELECT s.access_state, COALESCE(c.n, 0) AS n
FROM (VALUES ('granted'), ('pending'), ('revoked'), ('resigned')) s(access_state)
LEFT JOIN (SELECT access_state, COUNT(*) AS n FROM roster GROUP BY 1) c ON c.access_state = s.access_state""",
                                    usage_needed=False))
def q_roster_state_counts(spark, sf):
    return R.state_counts(spark, fx.roster(spark, sf))


@register("enrich_usage", W("""
SELECT usage_id, utc_time, usage_date, usage_hour, user_email, access_point, product_area, file_count,
       email, workforce_name, location, practice, team, designation FROM usage"""))
def q_enrich_usage(spark, sf):
    return fx.usage(spark, sf).select(
        "usage_id", "utc_time", "usage_date", "usage_hour", "user_email", "access_point", "product_area",
        "file_count", "email", "workforce_name", "location", "practice", "team", "designation")


@register("match_audit", W("""
SELECT COUNT(*) AS rows, COUNT(workforce_name) AS matched, COUNT(*) FILTER (WHERE workforce_name IS NULL) AS unmatched,
       MIN(usage_date) AS min_date, MAX(usage_date) AS max_date FROM usage"""))
def q_match_audit(spark, sf):
    return E.match_audit(fx.usage(spark, sf))


@register("unmatched_events", W("SELECT usage_id, user_email, usage_date FROM usage WHERE workforce_name IS NULL"))
def q_unmatched_events(spark, sf):
    return E.unmatched_events(fx.usage(spark, sf)).select("usage_id", "user_email", "usage_date")


@register("roster_from_usage", W("""
SELECT email, arg_min(workforce_name, (utc_time, usage_id)) AS workforce_name,
       arg_min(location, (utc_time, usage_id)) AS location, arg_min(designation, (utc_time, usage_id)) AS designation,
       arg_min(team, (utc_time, usage_id)) AS team, arg_min(practice, (utc_time, usage_id)) AS practice,
       'granted' AS access_state
FROM usage WHERE email IS NOT NULL GROUP BY email"""))
def q_roster_from_usage(spark, sf):
    return R.roster_from_usage(fx.usage(spark, sf))


@register("sync_metadata", W("""
SELECT COUNT(*) AS row_count, MIN(usage_date) AS min_date, MAX(usage_date) AS max_date,
       COUNT(*) FILTER (WHERE usage_date = (SELECT MAX(usage_date) FROM usage)) AS last_sync_rows
FROM usage"""))
def q_sync_metadata(spark, sf):
    return S.sync_metadata(fx.usage(spark, sf))


def _extract_text(spark, sf):
    """The enriched usage rendered as an extract: CSV header names, every value as text,
    with padding, upper case, '5.0'-style hours and blank ids mixed in."""
    u = fx.usage(spark, sf)
    eid = F.col("usage_id").cast("long")
    return u.select(
        F.concat(F.date_format("utc_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("utc_time"),
        F.col("usage_date").cast("string").alias("usage_date"),
        F.when(eid % 5 == 0, F.concat(F.col("usage_hour").cast("string"), F.lit(".0")))
        .otherwise(F.col("usage_hour").cast("string")).alias("usage_hour"),
        F.when(eid % 3 == 0, F.concat(F.lit(" "), F.upper("user_email"), F.lit(" "))).otherwise(F.col("user_email")).alias("user"),
        F.when(eid % 97 == 1, F.lit("")).when(eid % 2 == 0, F.concat(F.lit(" "), F.col("usage_id"), F.lit(" ")))
        .otherwise(F.col("usage_id")).alias("unique_usage_id"),
        "access_point",
        F.col("product_area").alias("product_surface_area"),
        F.col("file_count").cast("string").alias("file_count"),
        F.col("workforce_name").alias("Workforce Name"),
        F.col("location").alias("Location"),
        F.col("designation").alias("Designation"),
        F.col("team").alias("Team"),
        F.col("practice").alias("Practice/ Function"),
        F.col("email").alias("Email"),
    )


@register("canonical_extract", W("""
SELECT usage_id, utc_time, usage_date, usage_hour, user_email, access_point,
       NULLIF(trim(product_area), '') AS product_area, file_count, workforce_name, location, designation,
       team, NULLIF(trim(practice), '') AS practice, email
FROM usage WHERE CAST(usage_id AS BIGINT) % 97 <> 1"""))
def q_canonical_extract(spark, sf):
    from adoptlens.operators.extract import canonical_usage
    c = canonical_usage(_extract_text(spark, sf))
    return c.select("usage_id", "utc_time", "usage_date", "usage_hour", "user_email", "access_point", "product_area",
                    "file_count", "workforce_name", "location", "designation", "team", "practice", "email")
