"""Whole jobs and reports through the public functions: snapshots read back section by section,
documents and discrepancy files written and parsed, guards and stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adoptlens import api, jobs
from adoptlens.catalog import ORACLES, register
from adoptlens.catalog import adoption_q, bundle_q, dashboard_q, ingest_q, reconcile_q, report_q  # noqa: F401  (their oracles come first)
from adoptlens.catalog.bundle_q import _chart, _chart_sql, _people, _row, _row_sql, _together
from adoptlens.operators.versions import read_table
from adoptlens.plans import export as X
from adoptlens.plans import snapshots as SN
from adoptlens.plans.dashboard import teams_by_practice_map
from adoptlens.session import scratch_path
from adoptlens.sources import fixtures as fx
from adoptlens.sources.events_json import read_extract_csv, write_extract_csv
from adoptlens.sources.tables import require_rows

W = fx.with_fixtures


# --- snapshots -------------------------------------------------------------------------

def _span_sql(events: str) -> str:
    return f"(SELECT date_diff('day', MIN(usage_date), MAX(usage_date)) FROM {events})"


def _sections_sql(events: str) -> str:
    """Every unfiltered section over the table ``events`` in long form."""
    tools = f"""
WITH t AS (SELECT trim(unnest(string_split(COALESCE(product_area, ''), ','))) AS tool FROM {events}),
c AS (SELECT tool, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, tool) AS place FROM t WHERE tool <> '' GROUP BY tool)
SELECT {{}} FROM c"""
    counted = "GROUP BY 1"
    top = tools.format("CASE WHEN place <= 8 THEN tool ELSE 'Other' END AS label, SUM(n) AS value") + " GROUP BY 1"
    options = "\nUNION ALL ".join(
        f"SELECT DISTINCT '{name}/' || {col} AS label FROM {events} WHERE {col} <> ''"
        for name, col in (("practices", "practice"), ("locations", "location"), ("accesses", "access_point"), ("designations", "designation")))
    kpis = f"""SELECT COUNT(DISTINCT user_email) AS active_users, COUNT(*) AS total_actions,
       COUNT(DISTINCT practice) FILTER (WHERE practice <> '') AS practice_areas FROM {events}"""
    return "\nUNION ALL ".join([
        _row_sql("dashboard.kpis", kpis, ["active_users", "total_actions", "practice_areas"]),
        _chart_sql("dashboard.timeline", f"SELECT strftime(usage_date, '%Y-%m-%d') AS label, COUNT(*) AS value FROM {events} WHERE usage_date IS NOT NULL {counted}"),
        _chart_sql("dashboard.timeline_granularity", f"SELECT 'daily' AS label, {_span_sql(events)} AS value"),
        *[_chart_sql(f"dashboard.{c}", f"SELECT COALESCE({c}, 'Unknown') AS label, COUNT(*) AS value FROM {events} {counted}") for c in ("practice", "team", "location", "designation")],
        _chart_sql("dashboard.tools", top),
        _chart_sql("top_users", f"SELECT user_email AS label, COUNT(*) + 1000000 * COALESCE(SUM(file_count), 0) AS value FROM {events} WHERE user_email IS NOT NULL {counted}"),
        _chart_sql("filter_options", options, value="1"),
        _chart_sql("filter_options.products", tools.format("DISTINCT tool AS label"), value="1"),
        _chart_sql("filter_options.teams_by_practice", f"SELECT DISTINCT practice || '/' || team AS label FROM {events} WHERE practice <> '' AND team <> ''", value="1"),
    ])


def _usage_sections(read):
    """What ``_sections_sql`` says, of sections by name."""
    users = read("top_users").withColumn("value", F.col("actions") + 1000000 * F.col("files"))
    options = read("filter_options").select(F.concat_ws("/", "dimension", "value").alias("label"), F.lit(1).alias("value"))
    teams = read("filter_options.teams_by_practice").select(F.concat_ws("/", "practice", "team").alias("label"), F.lit(1).alias("value"))
    return _together([
        _row("dashboard.kpis", read("dashboard.kpis")),
        *[_chart(f"dashboard.{c}", read(f"dashboard.{c}")) for c in ("timeline", "practice", "team", "location", "designation", "tools")],
        _chart("dashboard.timeline_granularity", read("dashboard.timeline_granularity"), "granularity", "day_span"),
        _chart("top_users", users, "user"), _chart("filter_options", options), _chart("filter_options.teams_by_practice", teams),
        _chart("filter_options.products", read("filter_options.products").withColumn("value", F.lit(1)), "product"),
    ])


def _adoption_sections(read):
    charts = ["team_access_coverage", "team_adoption_rate", "practice_access_coverage", "access_funnel"]
    people = ["inactive_users", "pending_access", "revoked_users"]
    return _together([_row("kpis", read("kpis")), *[_chart(c, read(c)) for c in charts], *[_people(p, read(p)) for p in people]])


@register("snapshot_dashboard_bundle", W(f"SELECT * FROM ({_sections_sql('usage')}) WHERE section LIKE 'dashboard.%'"))
def q_snapshot_dashboard_bundle(spark, sf):
    """The unfiltered dashboard through the public function, answered by the snapshot alone."""
    root, usage = scratch_path(spark, "snapshots"), fx.usage(spark, sf)
    api.refresh_dashboard_cache(spark, usage, fx.roster(spark, sf), root)
    b = api.get_dashboard_bundle(spark, usage, snapshot_root=root)
    charts = ["timeline", "practice", "team", "location", "designation", "tools"]
    return _together([_row("dashboard.kpis", b["kpis"]), *[_chart(f"dashboard.{c}", b[c]) for c in charts],
                      _chart("dashboard.timeline_granularity", b["timeline_granularity"], "granularity", "day_span")])


@register("snapshot_adoption_bundle", ORACLES["adoption_bundle"])
def q_snapshot_adoption_bundle(spark, sf):
    """The unfiltered adoption report through the public function, answered by the snapshot alone."""
    root, usage, roster = scratch_path(spark, "snapshots"), fx.usage(spark, sf), fx.roster(spark, sf)
    api.refresh_dashboard_cache(spark, usage, roster, root)
    b = api.get_adoption_bundle(spark, roster, usage, snapshot_root=root)
    return _adoption_sections(b.get)


_MOVED = """
moved AS (
  SELECT * REPLACE (CASE WHEN usage_date = DATE '2024-01-05' THEN DATE '2024-01-06'
                         WHEN CAST(usage_id AS BIGINT) % 10 = 0 THEN NULL ELSE usage_date END AS usage_date,
                    CASE WHEN usage_date = DATE '2024-01-05' THEN 'Resynced,Vault' ELSE product_area END AS product_area) FROM usage
)"""


def _renewed(spark, sf) -> str:
    """A snapshot renewed after a day's events moved to the next day and changed their tools."""
    root, day, usage = scratch_path(spark, "snapshots"), F.col("usage_date"), fx.usage(spark, sf)
    none = F.when(F.col("usage_id").cast("long") % 10 == 0, F.lit(None)).otherwise(day)
    fifth = F.coalesce(day == F.lit("2024-01-05").cast("date"), F.lit(False))
    roster = fx.roster(spark, sf)
    SN.refresh(spark, usage.withColumn("usage_date", none), roster, root)
    after = usage.withColumns({"usage_date": F.when(fifth, F.lit("2024-01-06").cast("date")).otherwise(none),
                               "product_area": F.when(fifth, F.lit("Resynced,Vault")).otherwise(F.col("product_area"))})
    SN.refresh_incremental(spark, after, roster, root, [dt.date(2024, 1, 5), dt.date(2024, 1, 6), None])
    return root


@register("incremental_snapshot_sections", W(f"SELECT * FROM ({_sections_sql('moved')})", extra=(_MOVED,)))
def q_incremental_snapshot_sections(spark, sf):
    """Every section of the events after an incremental refresh."""
    root = _renewed(spark, sf)
    return _usage_sections(lambda name: SN.read_section(spark, root, name))


@register("incremental_snapshot_adoption", ORACLES["adoption_bundle"])
def q_incremental_snapshot_adoption(spark, sf):
    """Every section of the adoption report after an incremental refresh; it does not depend on the days."""
    root = _renewed(spark, sf)
    return _adoption_sections(lambda name: SN.read_section(spark, root, f"adoption.{name}"))


# --- documents and files ---------------------------------------------------------------

@register("team_report_document", ORACLES["team_report_bundle"])
def q_team_report_document(spark, sf):
    """The team report written as one JSON document in text files, and its rows parsed back."""
    path = scratch_path(spark, "document")
    api.get_team_report_document(spark, fx.roster(spark, sf), fx.usage(spark, sf), report_q.PRACTICE, report_q.TEAM, report_q.START, report_q.END, path=path)
    names = ["meta", "summary", "features", "members_with_access", "members_without_access"]
    rows = X.read_document(spark, path, names)

    def of(section: str, fields: str):
        return rows.where(F.col("section") == section).select(F.from_json("row", fields).alias("r")).select("r.*")

    summary = ", ".join(f"{n} double" for n in bundle_q._SUMMARY_NAMES)
    return _together([
        _row("summary", of("summary", summary)), _chart("features", of("features", "label string, count long"), "label", "count"),
        _chart("members_with_access", of("members_with_access", "user_email string, total_activity long"), "user_email", "total_activity"),
        _people("members_without_access", of("members_without_access", "email string")),
    ])


@register("teams_by_practice_document", W("""
SELECT practice, CAST(to_json(list(DISTINCT team ORDER BY team)) AS VARCHAR) AS teams FROM usage
WHERE practice <> '' AND team <> '' GROUP BY practice"""))
def q_teams_by_practice_document(spark, sf):
    """The map practice -> teams as a JSON object, taken apart again."""
    doc = teams_by_practice_map(fx.usage(spark, sf)).select(F.to_json("teams_by_practice").alias("doc"))
    return doc.select(F.explode(F.from_json("doc", "map<string,array<string>>")).alias("practice", "t")).select("practice", F.to_json("t").alias("teams"))


@register("export_top_users_files", f"SELECT line FROM ({ORACLES['export_top_user_lines']})")
def q_export_top_users_files(spark, sf):
    """The whole leaderboard written as ordered text files and read back."""
    path = scratch_path(spark, "export")
    api.write_top_users_csv(fx.usage(spark, sf), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("reconcile_files", reconcile_q.PAIR_SQL + """
SELECT 'only_in_left' AS part, unique_usage_id, access_point AS field, "user" AS left_value, NULL AS right_value
FROM l WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM r)
UNION ALL
SELECT 'only_in_right', unique_usage_id, access_point, NULL, "user" FROM r WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM l)
UNION ALL
SELECT 'field_mismatches', unique_usage_id, field, left_value, right_value FROM diffs""")
def q_reconcile_files(spark, sf):
    """The three discrepancy files of a reconciliation, read back."""
    base = scratch_path(spark, "reconcile")
    for name, side in (("left", reconcile_q._left(spark, sf)), ("right", reconcile_q._right(spark, sf))):
        text = side.withColumn("utc_time", F.date_format("utc_time", "yyyy-MM-dd HH:mm:ss"))
        write_extract_csv(text.orderBy("src_ord").drop("src_ord"), f"{base}/{name}")
    jobs.reconcile_extracts(spark, f"{base}/left", f"{base}/right", f"{base}/out")
    read = lambda part: read_extract_csv(spark, f"{base}/out/{part}").withColumn("part", F.lit(part))
    none = F.lit(None).cast("string")
    sides = [read("only_in_left").select("part", "unique_usage_id", F.col("access_point").alias("field"), F.col("user").alias("left_value"), none.alias("right_value")),
             read("only_in_right").select("part", "unique_usage_id", F.col("access_point").alias("field"), none.alias("left_value"), F.col("user").alias("right_value"))]
    return _together([*sides, read("field_mismatches").select("part", "unique_usage_id", "field", "left_value", "right_value")])


@register("bulk_import_one_file", W("""
SELECT usage_id, usage_date, user_email, rtrim('line one' || chr(10) || '"two", ' || COALESCE(product_area, '')) AS product_area FROM usage"""))
def q_bulk_import_one_file(spark, sf):
    """An extract in one CSV file whose cells hold line breaks, quotes and commas, bulk-imported."""
    base = scratch_path(spark, "bulk")
    text = F.concat(F.lit('line one\n"two", '), F.coalesce(F.col("product_area"), F.lit("")))
    rows = fx.usage(spark, sf).select(F.col("usage_id").alias("unique_usage_id"), F.date_format("utc_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("utc_time"),
                                      F.col("user_email").alias("user"), "access_point", text.alias("product_surface_area"))
    rows.write.parquet(f"{base}/rows")  # joined by many tasks; the one that writes the file only copies
    rows = spark.read.schema(rows.schema).parquet(f"{base}/rows")
    write_extract_csv(rows.coalesce(1), f"{base}/csv")  # the fixture is one file on purpose
    jobs.bulk_import(spark, f"{base}/csv", f"{base}/usage")
    return read_table(spark, f"{base}/usage").select("usage_id", "usage_date", "user_email", "product_area")


# --- guards and stamps -----------------------------------------------------------------

@register("roster_scan", W("SELECT email, workforce_name, practice, access_state FROM roster", usage_needed=False))
def q_roster_scan(spark, sf):
    """The stored roster, imported, read whole and found not to be empty."""
    base = scratch_path(spark, "roster")
    raw = fx.roster_source(spark, sf).select(F.col("email").alias("Email"), F.col("workforce_name").alias("Workforce Name"), F.col("raw_status").alias("Status"),
                                             F.coalesce(F.col("practice"), F.lit("")).alias("Practice/ Function"), "src_ord")
    jobs.import_roster(spark, raw, f"{base}/roster")
    names = fx.roster(spark, sf).select("email", F.col("practice").alias("p"))
    stored = require_rows(spark.read.parquet(f"{base}/roster"), "roster").join(names, "email")
    # blanks are stored as nulls; the source tells them apart
    return stored.select("email", "workforce_name", F.when(F.col("practice").isNull(), F.col("p")).otherwise(F.col("practice")).alias("practice"), "access_state")


@register("sync_keeps_first_stamp", W("""
SELECT usage_id, usage_date < DATE '2024-01-16' AS first_stamp FROM usage WHERE usage_date < DATE '2024-02-01'"""))
def q_sync_keeps_first_stamp(spark, sf):
    """Events synced again keep the time they were first stored at."""
    base = scratch_path(spark, "sync")
    raw, roster = fx.raw_events(spark, sf), fx.roster(spark, sf)
    jobs.sync_window(spark, raw, roster, f"{base}/usage", f"{base}/meta", "2024-01-01", "2024-01-16")
    stamp = read_table(spark, f"{base}/usage").agg(F.max("synced_at")).first()[0]
    jobs.sync_window(spark, raw, roster, f"{base}/usage", f"{base}/meta", "2024-01-01", "2024-02-01")
    return read_table(spark, f"{base}/usage").select("usage_id", (F.col("synced_at") <= F.lit(stamp)).alias("first_stamp"))


@register("sync_info", W("""
SELECT COUNT(*) AS row_count, MIN(usage_date) AS min_date, MAX(usage_date) AS max_date, COUNT(*) AS last_sync_rows FROM usage
WHERE usage_date < DATE '2024-03-01'"""))
def q_sync_info(spark, sf):
    """The stored metadata of a sync over all days, read by the public function."""
    base = scratch_path(spark, "sync")
    jobs.sync_window(spark, fx.raw_events(spark, sf), fx.roster(spark, sf), f"{base}/usage", f"{base}/meta", "2023-12-01", "2024-03-01")
    return api.get_sync_info(spark, f"{base}/meta").select("row_count", "min_date", "max_date", "last_sync_rows")


# --- every public function -------------------------------------------------------------

def _count_sql(name: str, body: str) -> str:
    return f"SELECT '{name}' AS name, COUNT(*) AS n FROM ({body})"


@register("public_functions", "\nUNION ALL ".join([
    _count_sql("get_dashboard_bundle", ORACLES["count_by_location"]), _count_sql("get_top_users", ORACLES["top_users"]),
    _count_sql("get_usage_page", W("SELECT usage_id FROM usage LIMIT 20")), _count_sql("export_usage_csv", ORACLES["export_usage_lines"]),
    _count_sql("export_top_users_csv", ORACLES["export_top_user_lines"]), _count_sql("get_filter_options", ORACLES["filter_options"]),
    _count_sql("get_adoption_bundle", ORACLES["inactive_members"]), _count_sql("get_adoption_filter_options", ORACLES["adoption_filter_options"]),
    _count_sql("get_team_report_bundle", ORACLES["report_members"]), _count_sql("sync_metadata", "SELECT 1"),
]))
def q_public_functions(spark, sf):
    """Rows that each public report function returns with nothing but its required arguments."""
    usage, roster = fx.usage(spark, sf), fx.roster(spark, sf)
    report = api.get_team_report_bundle(spark, roster, usage, report_q.PRACTICE, report_q.TEAM, report_q.START, report_q.END)
    results = {
        "get_dashboard_bundle": api.get_dashboard_bundle(spark, usage)["location"], "get_top_users": api.get_top_users(spark, usage),
        "get_usage_page": api.get_usage_page(usage)["rows"], "export_usage_csv": api.export_usage_csv(usage),
        "export_top_users_csv": api.export_top_users_csv(usage), "get_filter_options": api.get_filter_options(spark, usage)["values"],
        "get_adoption_bundle": api.get_adoption_bundle(spark, roster, usage)["inactive_users"],
        "get_adoption_filter_options": api.get_adoption_filter_options(roster), "get_team_report_bundle": report["members_with_access"],
        "sync_metadata": api.sync_metadata(usage),
    }
    return _together([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in results.items()])
