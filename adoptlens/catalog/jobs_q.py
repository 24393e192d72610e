"""Jobs with side effects, run into the shared checkpoint folder and read back, so their
results pass through the same oracle comparison as the pure queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adoptlens import api, jobs
from adoptlens.catalog import ORACLES, register
from adoptlens.catalog import dashboard_q, ingest_q  # noqa: F401  (oracles registered first)
from adoptlens.operators.versions import read_table
from adoptlens.plans import snapshots as SN
from adoptlens.session import scratch_path
from adoptlens.sources.events_json import flatten, read_documents, read_extract_csv, to_usage_events
from adoptlens.sources.tables import table
from adoptlens.sources import fixtures as fx

W = fx.with_fixtures
#: A window around every event of the tables.
ALL_DAYS = ("2023-12-01", "2024-04-01")


@register("snapshot_top_users", ORACLES["top_users"])
def q_snapshot_top_users(spark, sf):
    """Full cache refresh (one scan into the rollup, every section written), then the
    leaderboard section read back from the current snapshot."""
    root = scratch_path(spark, "snapshots")
    SN.refresh(spark, fx.usage(spark, sf), fx.roster(spark, sf), root)
    return SN.read_section(spark, root, "top_users")


@register("bulk_import_extract", ORACLES["canonical_extract"])
def q_bulk_import_extract(spark, sf):
    """Enriched extract written as CSV text, bulk-imported into the usage table, read back."""
    base = scratch_path(spark, "bulk")
    ingest_q._extract_text(spark, sf).write.option("header", True).csv(f"{base}/csv")
    jobs.bulk_import(spark, f"{base}/csv", f"{base}/usage")
    t = read_table(spark, f"{base}/usage")
    return t.select("usage_id", "utc_time", "usage_date", "usage_hour", "user_email", "access_point", "product_area",
                    "file_count", "workforce_name", "location", "designation", "team", "practice", "email")


@register("sync_backfill", W("""
SELECT usage_id, usage_date, user_email, workforce_name, practice FROM usage
WHERE usage_date >= DATE '2024-01-01' AND usage_date < DATE '2024-02-01'"""))
def q_sync_backfill(spark, sf):
    """Daily sync of one day, then a month back-fill over it (idempotent upsert)."""
    base = scratch_path(spark, "sync")
    raw, roster = fx.raw_events(spark, sf), fx.roster(spark, sf)
    jobs.sync_window(spark, raw, roster, f"{base}/usage", f"{base}/meta", "2024-01-15", "2024-01-16")
    jobs.sync_window(spark, raw, roster, f"{base}/usage", f"{base}/meta", "2024-01-01", "2024-02-01")
    t = read_table(spark, f"{base}/usage")
    return t.select("usage_id", "usage_date", "user_email", "workforce_name", "practice")


# --- documents, extract and roster jobs ------------------------------------------------

@register("event_documents", """
SELECT CAST(event_id AS VARCHAR) AS usage_id, ts AS utc_time, CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date,
       CAST(EXTRACT(HOUR FROM ts + INTERVAL '330' MINUTE) AS INT) AS usage_hour, 'user' || user_id AS "user",
       event_type AS access_point, CAST(event_id % 4 AS INT) AS file_count
FROM events""")
def q_event_documents(spark, sf):
    """Events written as JSON documents, their times in three offsets, read back and flattened."""
    base = scratch_path(spark, "documents")
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    eid = F.col("event_id")
    zone = lambda z, sign: F.concat(F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(z), F.col("ts").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(sign))
    when = F.when(eid % 3 == 0, zone("UTC", "Z")).when(eid % 3 == 1, zone("Asia/Kolkata", "+05:30")).otherwise(zone("-08:00", "-08:00"))
    ids = F.transform(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < eid % 4), lambda i: F.concat(F.lit("f"), i.cast("string")))
    event = F.struct(when.alias("utc_time"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
                     eid.cast("string").alias("unique_usage_id"), F.col("event_type").alias("access_point"), ids.alias("file_ids"))
    docs = e.groupBy(F.floor(eid / 100).alias("doc")).agg(F.collect_list(event).alias("events")).select("events")
    docs.write.json(f"{base}/json")
    flat = to_usage_events(flatten(read_documents(spark, f"{base}/json", multi_line=False)))
    return flat.select("usage_id", "utc_time", "usage_date", "usage_hour", "user", "access_point", "file_count")


@register("export_extract_csv", W("""
SELECT 'extract' AS part, usage_id, strftime(usage_date, '%Y-%m-%d') AS usage_date, user_email FROM usage
WHERE usage_date >= DATE '2024-01-08' AND usage_date < DATE '2024-01-20'
UNION ALL
SELECT 'archive', usage_id, strftime(usage_date, '%Y-%m-%d'), user_email FROM usage
WHERE usage_date >= DATE '2024-01-15' AND usage_date < DATE '2024-01-20'
UNION ALL
SELECT 'unmatched', usage_id, strftime(usage_date, '%Y-%m-%d'), user_email FROM usage
WHERE usage_date >= DATE '2024-01-08' AND usage_date < DATE '2024-01-20' AND workforce_name IS NULL"""))
def q_export_extract_csv(spark, sf):
    """Two overlapping windows exported with append; extract, archive and rejects read back from CSV."""
    base = scratch_path(spark, "extract")
    raw, roster = fx.raw_events(spark, sf), fx.roster(spark, sf)
    jobs.export_extract(spark, raw, roster, base, "2024-01-08", "2024-01-17")
    jobs.export_extract(spark, raw, roster, base, "2024-01-15", "2024-01-20", csv=True)
    parts = {"extract": "extract", "archive": "archive/usage_enriched_2024-01-15_to_2024-01-19", "unmatched": "unmatched"}
    out = None
    for part, path in parts.items():
        rows = read_extract_csv(spark, f"{base}/csv/{path}").select(F.lit(part).alias("part"), "usage_id", "usage_date", "user_email")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("sync_cut_window", W("""
SELECT usage_id, usage_date, user_email, workforce_name, practice FROM usage
WHERE usage_date >= DATE '2024-01-10' AND usage_date < DATE '2024-01-20'"""))
def q_sync_cut_window(spark, sf):
    """A window that cuts the events at local midnight on both sides."""
    base = scratch_path(spark, "sync")
    jobs.sync_window(spark, fx.raw_events(spark, sf), fx.roster(spark, sf), f"{base}/usage", f"{base}/meta", "2024-01-10", "2024-01-20")
    return read_table(spark, f"{base}/usage").select("usage_id", "usage_date", "user_email", "workforce_name", "practice")


@register("sync_without_rows", W("""
SELECT COUNT(*) AS row_count, MIN(usage_date) AS min_date, MAX(usage_date) AS max_date, CAST(0 AS BIGINT) AS last_sync_rows
FROM usage"""))
def q_sync_without_rows(spark, sf):
    """A sync that brings nothing still renews the metadata."""
    base = scratch_path(spark, "sync")
    raw, roster = fx.raw_events(spark, sf), fx.roster(spark, sf)
    jobs.sync_window(spark, raw, roster, f"{base}/usage", f"{base}/meta", *ALL_DAYS)
    return jobs.sync_window(spark, raw, roster, f"{base}/usage", f"{base}/meta", "2030-01-01", "2030-01-02").drop("last_sync")


@register("sync_corrected_event", W("""
SELECT usage_id, usage_date + CASE WHEN CAST(usage_id AS BIGINT) % 5 = 0 THEN 3 ELSE 0 END AS usage_date
FROM usage"""))
def q_sync_corrected_event(spark, sf):
    """Every fifth event is pulled again three days later: it is stored once, on its new day."""
    base = scratch_path(spark, "sync")
    raw, roster = fx.raw_events(spark, sf), fx.roster(spark, sf)
    jobs.sync_window(spark, raw, roster, f"{base}/usage", f"{base}/meta", *ALL_DAYS)
    again = raw.filter(F.col("usage_id").cast("long") % 5 == 0)
    moved = again.withColumn("utc_time", F.timestamp_add("DAY", F.lit(3), F.col("utc_time")).cast("timestamp_ntz"))
    jobs.sync_window(spark, moved, roster, f"{base}/usage", f"{base}/meta", *ALL_DAYS)
    return read_table(spark, f"{base}/usage").select("usage_id", "usage_date")


@register("import_roster_job", W("""
SELECT email, workforce_name, location, NULLIF(practice, '') AS practice, team, designation, raw_status, access_state
FROM roster""", usage_needed=False))
def q_import_roster_job(spark, sf):
    """The roster as a CSV file with padded headers, upper-case e-mails and blanks, imported."""
    base = scratch_path(spark, "roster")
    r = fx.roster_source(spark, sf)
    r.select(F.concat(F.lit(" "), F.upper("email")).alias("Email"), F.col("workforce_name").alias(" Workforce Name "),
             F.col("location").alias("Location"), F.col("practice").alias("Practice/ Function "), F.col("team").alias("Team"),
             F.col("designation").alias(" Designation"), F.col("raw_status").alias("Status"),
             "src_ord").write.option("header", True).option("escape", '"').csv(f"{base}/csv")
    raw = read_extract_csv(spark, f"{base}/csv").withColumn("src_ord", F.col("src_ord").cast("long"))
    out = jobs.import_roster(spark, raw, f"{base}/roster")["roster"]
    return out.select("email", "workforce_name", "location", "practice", "team", "designation", "raw_status", "access_state")


@register("sync_one_day", W("""
SELECT usage_id, usage_date FROM usage WHERE usage_date = DATE '2024-01-12'"""))
def q_sync_one_day(spark, sf):
    """The daily mode of the sync."""
    base = scratch_path(spark, "sync")
    jobs.sync(spark, fx.raw_events(spark, sf), fx.roster(spark, sf), f"{base}/usage", f"{base}/meta", day="2024-01-12")
    return read_table(spark, f"{base}/usage").select("usage_id", "usage_date")


@register("export_usage_files", f"SELECT line FROM ({ORACLES['export_usage_lines']})")
def q_export_usage_files(spark, sf):
    """The complete detail export written as text files and read back."""
    path = scratch_path(spark, "export")
    api.write_usage_csv(fx.usage(spark, sf), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("incremental_snapshot", W("""
SELECT 'practice' AS section, COALESCE(practice, 'Unknown') AS label, COUNT(*) AS value FROM moved GROUP BY 2
UNION ALL
SELECT 'timeline', strftime(usage_date, '%Y-%m-%d'), COUNT(*) FROM moved WHERE usage_date IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'total', 'total', COUNT(*) FROM moved""", extra=("""
moved AS (
  SELECT * REPLACE (CASE WHEN usage_date = DATE '2024-01-05' THEN DATE '2024-01-06'
                         WHEN CAST(usage_id AS BIGINT) % 10 = 0 THEN NULL ELSE usage_date END AS usage_date) FROM usage
)""",)))
def q_incremental_snapshot(spark, sf):
    """A snapshot renewed after the events of a day moved to the next; every tenth event has no day."""
    root = scratch_path(spark, "snapshots")
    day, usage = F.col("usage_date"), fx.usage(spark, sf)
    none = F.when(F.col("usage_id").cast("long") % 10 == 0, F.lit(None))
    before = usage.withColumn("usage_date", none.otherwise(day))
    fifth = day == F.lit("2024-01-05").cast("date")
    after = usage.withColumn("usage_date", F.when(fifth, F.lit("2024-01-06").cast("date")).otherwise(none.otherwise(day)))
    roster = fx.roster(spark, sf)
    SN.refresh(spark, before, roster, root)
    SN.refresh_incremental(spark, after, roster, root, [dt.date(2024, 1, 5), dt.date(2024, 1, 6), None])
    parts = [SN.read_section(spark, root, f"dashboard.{s}").select(F.lit(s).alias("section"), "label", "value") for s in ("practice", "timeline")]
    total = SN.read_section(spark, root, "dashboard.kpis").select(F.lit("total").alias("section"), F.lit("total").alias("label"), F.col("total_actions").alias("value"))
    return parts[0].unionByName(parts[1]).unionByName(total)
