"""End-to-end batch jobs composed from the operators (the reference's scripts as Spark jobs).

* ``export_extract``  window -> clean -> first-wins per id -> roster join -> audit ->
                      append-merge with the stored extract -> extract + archive + rejects
* ``import_roster``   roster file -> records -> duplicate merge -> keyed upsert -> counts
* ``reconcile_extracts``  two CSV extracts -> discrepancies and a pass/fail summary
* ``sync_window``     one local day (or any window, i.e. a back-fill) -> upsert into the
                      date-partitioned usage table -> metadata, also when nothing arrived
Every write of a table that is also read goes through a staging copy in the shared
checkpoint folder first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ, archive_label, resolve_window, window_predicate
from adoptlens.operators import dedupe, enrich, reconcile, roster
from adoptlens.operators.upsert import read_table, upsert_into_table
from adoptlens.plans.dashboard import top_users
from adoptlens.plans.sync import sync_metadata
from adoptlens.session import path_exists, remove_path, scratch_path, scratch_scope
from adoptlens.sources.events_json import read_ordered_csv, write_extract_csv
from adoptlens.sources.tables import require_rows

# Row order inside usage files: dashboard filters on practice/team skip row groups.
USAGE_CLUSTER = ("practice", "team", "user_email")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None where there is nothing yet; an unreadable one raises."""
    return read_table(spark, path) if path_exists(spark, path) else None


def _overwrite_via_stage(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet", **opts) -> None:
    stage = scratch_path(spark, "stage")
    df.write.mode("overwrite").format("parquet").save(stage)
    out = spark.read.parquet(stage).write.mode("overwrite").format(fmt)
    for k, v in opts.items():
        out = out.option(k, v)
    out.save(path)
    remove_path(spark, stage)


def keyed_roster(roster_df: DataFrame) -> DataFrame:
    """One row per e-mail before any join, so duplicated roster rows can never fan out
    events (the first row by its other columns wins; use ``roster.merge_duplicates`` with a
    file ordinal for the full precedence rules)."""
    return dedupe.keep_first(roster_df.filter(F.col("email").isNotNull()), ["email"], [])


def window_events(raw: DataFrame, start: str | dt.date, end: str | dt.date, tz: str = DEFAULT_TZ) -> DataFrame:
    """Raw events of local days [start, end): predicate on the stored instant (pushed down)."""
    return raw.filter(window_predicate("utc_time", start, end, tz))


def export_extract(spark: SparkSession, raw: DataFrame, roster_df: DataFrame, out_dir: str,
                   start: str, end: str, append: bool = True, archive: bool = True,
                   order_col: str = "utc_time", tz: str = DEFAULT_TZ, csv: bool = False) -> dict[str, DataFrame]:
    """Enriched extract for local days [start, end) (raw needs usage_id, user, utc_time, ...).

    Writes ``extract`` (Parquet; merged with the stored one in append mode: new rows win per
    id, result ordered by time), ``archive/<label>`` (the new chunk only) and ``unmatched``
    (rows of the final extract whose user matched no roster name). Returns the audit, the
    extract's date range and the top-10 users as DataFrames. ``csv``: the three tables are
    written as CSV part files too, under ``csv/``.
    """
    require_rows(roster_df, "roster")  # enrichment without a roster is an error, as in the reference
    base = out_dir.rstrip("/")
    chunk = window_events(raw, start, end, tz)
    events = enrich.normalize_events(chunk, tz)
    # overlapping fetches: first occurrence of an id wins
    events = dedupe.keep_first(events, ["usage_id"], [order_col])
    new = enrich.enrich_usage(events, keyed_roster(roster_df))
    final = new
    if append:
        stored = _read_or_none(spark, f"{base}/extract")
        if stored is not None:
            final = dedupe.merge_newer(stored, new, ["usage_id"], [order_col])
    final = final.orderBy(order_col, "usage_id")
    _overwrite_via_stage(spark, final, f"{base}/extract")
    if archive:
        new.orderBy(order_col, "usage_id").write.mode("overwrite").parquet(f"{base}/archive/{archive_label(start, end)}")
    written = spark.read.parquet(f"{base}/extract")
    rejects = enrich.unmatched_events(written)
    rejects.write.mode("overwrite").parquet(f"{base}/unmatched")
    if csv:
        write_extract_csv(written.orderBy(order_col, "usage_id"), f"{base}/csv/extract")
        write_extract_csv(new.orderBy(order_col, "usage_id"), f"{base}/csv/archive/{archive_label(start, end)}")
        write_extract_csv(rejects.orderBy(order_col, "usage_id"), f"{base}/csv/unmatched")
    return {"audit": enrich.match_audit(new), "top_10_users": top_users(new, 10), "extract": written}


def import_roster(spark: SparkSession, raw_file: DataFrame, roster_path: str,
                  ord_col: str = "src_ord") -> dict[str, DataFrame]:
    """Roster file -> cleaned records -> duplicate merge -> upsert into the stored roster.

    ``raw_file`` must carry a file ordinal column ``ord_col`` (row order of the file).
    """
    records = roster.records_from_file(raw_file, ord_col).withColumn("updated_at", F.current_timestamp())
    dups = roster.duplicate_emails(records)
    merged = roster.merge_duplicates(records, ord_col, roster.ROSTER_FIELDS + [
        c for c in ["workforce_id", "reporting_manager_name", "phase", "low_usage_warning",
                    "training_attendance", "cohort_training_attendance", "notes", "date_of_joining",
                    "date_added", "updated_at"] if c in records.columns])
    stored = _read_or_none(spark, roster_path)
    result = roster.upsert(stored, merged) if stored is not None else merged
    _overwrite_via_stage(spark, result, roster_path)
    current = spark.read.parquet(roster_path)
    return {"state_counts": roster.state_counts(spark, current), "duplicates": dups, "roster": current}


def bulk_import(spark: SparkSession, csv_path: str, table_path: str, tz: str = DEFAULT_TZ, multi_line: bool = True) -> int:
    """One-time load of an enriched CSV extract into the date-partitioned usage table.

    The file is read as text with its header, mapped to canonical rows and upserted; a key
    repeated keeps its last row, in the order of file names and of the rows within a file.
    Quoted cells may hold commas, quotes and line breaks. Returns the number of rows in the
    table afterwards.
    """
    from adoptlens.operators.extract import canonical_usage

    with scratch_scope(spark):
        rows = canonical_usage(read_ordered_csv(spark, csv_path, "_ord", multi_line), tz, keep=["_ord"])
        rows = dedupe.keep_last(rows, ["usage_id"], ["_ord"]).drop("_ord")
        upsert_into_table(spark, table_path, rows, ["usage_id"], ["utc_time"], "usage_date", cluster_by=USAGE_CLUSTER)
    return read_table(spark, table_path).count()


def sync(spark: SparkSession, raw: DataFrame, roster_df: DataFrame, table_path: str, meta_path: str, *,
         month: str | None = None, day: str | None = None, start: str | None = None, end: str | None = None,
         tz: str = DEFAULT_TZ, snapshot_root: str | None = None) -> DataFrame:
    """``sync_window`` over a month, a day, a range, or (nothing given) yesterday."""
    first, last = resolve_window(month=month, day=day, start=start, end=end, tz=tz)
    return sync_window(spark, raw, roster_df, table_path, meta_path, first, last, tz, snapshot_root)


def sync_window(spark: SparkSession, raw: DataFrame, roster_df: DataFrame, table_path: str, meta_path: str,
                start: str | dt.date, end: str | dt.date, tz: str = DEFAULT_TZ,
                snapshot_root: str | None = None) -> DataFrame:
    """Idempotent load of local days [start, end) into the usage table, then metadata.

    The daily run uses one day; a back-fill passes a longer window (no fetch-size limit
    applies to a Spark job). The metadata step runs even when the window brought nothing.
    With ``snapshot_root`` the dashboard snapshot is refreshed incrementally: only the local
    days this sync touched are re-aggregated.
    """
    require_rows(roster_df, "roster")
    events = enrich.normalize_events(window_events(raw, start, end, tz), tz)
    # synced_at: first time the event was stored; a re-sync keeps it
    rows = enrich.enrich_usage(events, keyed_roster(roster_df)).withColumn("synced_at", F.current_timestamp())
    # overlapping fetches: the first occurrence of an id counts, once
    rows = dedupe.keep_first(rows, ["usage_id"], ["utc_time"])
    staged = scratch_path(spark, "sync")
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    n, touched = rows.count(), []
    if n:
        touched = upsert_into_table(spark, table_path, rows, ["usage_id"], ["utc_time"], "usage_date",
                                    keep_existing=["synced_at"], cluster_by=USAGE_CLUSTER)
    remove_path(spark, staged)
    table = _read_or_none(spark, table_path)
    if table is None:
        return spark.createDataFrame([], "row_count bigint, min_date date, max_date date, last_sync_rows bigint")
    meta = sync_metadata(table, n).withColumn("last_sync", F.current_timestamp())
    _overwrite_via_stage(spark, meta, meta_path)
    if snapshot_root and n:
        from adoptlens.plans import snapshots

        snapshots.refresh_incremental(spark, table, keyed_roster(roster_df), snapshot_root, touched)
    return spark.read.parquet(meta_path)


def _parsed(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """An extract parsed once for the several comparisons that read it."""
    rows = read_ordered_csv(spark, path, "src_ord", multi_line)
    stored = scratch_path(spark, "extract")
    rows.write.parquet(stored)
    return spark.read.schema(rows.schema).parquet(stored)


def reconcile_extracts(spark: SparkSession, left_csv: str, right_csv: str, out_dir: str, multi_line: bool = True) -> DataFrame:
    """Compare two CSV extracts of the same events: one-row summary; discrepancies as CSV files."""
    path = f"{out_dir.rstrip('/')}/summary"
    with scratch_scope(spark):
        left, right = (_parsed(spark, p, multi_line) for p in (left_csv, right_csv))
        lc, rc = reconcile.clean_ids(left), reconcile.clean_ids(right)
        both, stored = reconcile.compared(lc, rc, "src_ord"), scratch_path(spark, "compared")
        both.write.parquet(stored)
        both = spark.read.schema(both.schema).parquet(stored)
        reconcile.write_discrepancies(left, right, out_dir, "src_ord", both=both)
        result = reconcile.summary(lc, rc, "src_ord", both=both)
        result.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
