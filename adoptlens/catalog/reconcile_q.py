"""Reconciliation queries: `events` as two extracts of the same events.

Left side: ids with event_id % 300 = 0 come a second time, later in the file, with another user.
Right side: ids with event_id % 97 = 0 missing, copies under id + 1,000,000,000 for
event_id % 500 = 0, and access point 'x' where event_id % 50 = 0.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from adoptlens import jobs
from adoptlens.catalog import ORACLES, register
from adoptlens.operators import reconcile as RC
from adoptlens.session import scratch_path
from adoptlens.sources.events_json import write_extract_csv
from adoptlens.sources.tables import table


def _left(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    eid = F.col("event_id")
    first = e.select(
        eid.cast("string").alias("unique_usage_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("user"),
        F.col("event_type").alias("access_point"),
        F.col("ts").alias("utc_time"),
        eid.alias("src_ord"),
    )
    again = first.filter(eid % 300 == 0).withColumns({"user": F.lit("aaa@example.com"), "src_ord": F.col("src_ord") + 2000000000})
    return first.unionByName(again)


def _right(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    eid = F.col("event_id")
    ap = F.when(eid % 50 == 0, F.lit("x")).otherwise(F.col("event_type"))
    user = F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
    kept = e.filter(eid % 97 != 0).select(eid.cast("string").alias("unique_usage_id"), user.alias("user"),
                                          ap.alias("access_point"), F.col("ts").alias("utc_time"), eid.alias("src_ord"))
    copies = e.filter(eid % 500 == 0).select((eid + 1000000000).cast("string").alias("unique_usage_id"),
                                             user.alias("user"), ap.alias("access_point"),
                                             F.col("ts").alias("utc_time"), (eid + 1000000000).alias("src_ord"))
    return kept.unionByName(copies)


PAIR_SQL = """
WITH first_l AS (
  SELECT CAST(event_id AS VARCHAR) AS unique_usage_id, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS "user",
         event_type AS access_point, ts AS utc_time FROM events
),
l AS (
  SELECT * FROM first_l
  UNION ALL
  SELECT CAST(event_id AS VARCHAR), 'aaa@example.com', event_type, ts FROM events WHERE event_id % 300 = 0
),
r AS (
  SELECT CAST(event_id AS VARCHAR) AS unique_usage_id, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS "user",
         CASE WHEN event_id % 50 = 0 THEN 'x' ELSE event_type END AS access_point, ts AS utc_time
  FROM events WHERE event_id % 97 <> 0
  UNION ALL
  SELECT CAST(event_id + 1000000000 AS VARCHAR), 'user' || CAST(user_id AS VARCHAR) || '@example.com',
         CASE WHEN event_id % 50 = 0 THEN 'x' ELSE event_type END, ts
  FROM events WHERE event_id % 500 = 0
),
j AS (
  SELECT l.unique_usage_id,
    regexp_replace(trim(COALESCE(l."user", '')), '\\+00:00$', '') AS lu, regexp_replace(trim(COALESCE(r."user", '')), '\\+00:00$', '') AS ru,
    regexp_replace(trim(COALESCE(l.access_point, '')), '\\+00:00$', '') AS la, regexp_replace(trim(COALESCE(r.access_point, '')), '\\+00:00$', '') AS ra,
    COALESCE(strftime(l.utc_time, '%Y-%m-%d %H:%M:%S'), '') AS lt, COALESCE(strftime(r.utc_time, '%Y-%m-%d %H:%M:%S'), '') AS rt
  FROM first_l l JOIN r ON l.unique_usage_id = r.unique_usage_id
),
diffs AS (
  SELECT unique_usage_id, 'user' AS field, lu AS left_value, ru AS right_value FROM j WHERE lu <> ru
  UNION ALL SELECT unique_usage_id, 'access_point', la, ra FROM j WHERE la <> ra
  UNION ALL SELECT unique_usage_id, 'utc_time', lt, rt FROM j WHERE lt <> rt
)
"""


@register("reconcile_only_left", PAIR_SQL + "SELECT * FROM l WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM r)")
def q_reconcile_only_left(spark, sf):
    return RC.only_in(RC.clean_ids(_left(spark, sf)), RC.clean_ids(_right(spark, sf))).drop("src_ord")


@register("reconcile_only_right", PAIR_SQL + "SELECT * FROM r WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM l)")
def q_reconcile_only_right(spark, sf):
    return RC.only_in(RC.clean_ids(_right(spark, sf)), RC.clean_ids(_left(spark, sf))).drop("src_ord")


@register("reconcile_fields", PAIR_SQL + "SELECT * FROM diffs")
def q_reconcile_fields(spark, sf):
    return RC.field_mismatches(RC.clean_ids(_left(spark, sf)), RC.clean_ids(_right(spark, sf)), "src_ord")


@register("reconcile_by_digest", PAIR_SQL + "SELECT * FROM diffs")
def q_reconcile_by_digest(spark, sf):
    """The differing fields, with whole rows moved only for ids whose digests differ."""
    return RC.field_mismatches_by_digest(RC.clean_ids(_left(spark, sf)), RC.clean_ids(_right(spark, sf)), "src_ord")


@register("reconcile_summary", PAIR_SQL + """
SELECT (SELECT COUNT(*) FROM l) AS left_rows, (SELECT COUNT(*) FROM r) AS right_rows,
       (SELECT COUNT(DISTINCT unique_usage_id) FROM l) AS left_ids,
       (SELECT COUNT(DISTINCT unique_usage_id) FROM r) AS right_ids,
       (SELECT COUNT(DISTINCT unique_usage_id) FROM l WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM r)) AS only_left,
       (SELECT COUNT(*) FROM r WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM l)) AS only_right,
       (SELECT COUNT(DISTINCT unique_usage_id) FROM l WHERE unique_usage_id IN (SELECT unique_usage_id FROM r)) AS shared,
       (SELECT COUNT(*) FROM diffs) AS field_mismatches,
       (SELECT COUNT(*) FROM diffs) = 0
         AND (SELECT COUNT(*) FROM l WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM r)) = 0
         AND (SELECT COUNT(*) FROM r WHERE unique_usage_id NOT IN (SELECT unique_usage_id FROM l)) = 0 AS passed""")
def q_reconcile_summary(spark, sf):
    return RC.summary(RC.clean_ids(_left(spark, sf)), RC.clean_ids(_right(spark, sf)), "src_ord")


@register("reconcile_job", ORACLES["reconcile_summary"])
def q_reconcile_job(spark, sf):
    """Both extracts as CSV files, compared by the job."""
    base = scratch_path(spark, "reconcile")
    for name, side in (("left", _left(spark, sf)), ("right", _right(spark, sf))):
        text = side.withColumn("utc_time", F.date_format("utc_time", "yyyy-MM-dd HH:mm:ss"))
        write_extract_csv(text.orderBy("src_ord").drop("src_ord"), f"{base}/{name}")
    return jobs.reconcile_extracts(spark, f"{base}/left", f"{base}/right", f"{base}/out")
