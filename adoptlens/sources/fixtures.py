"""Projections of the driver tables onto the engine's two core schemas (roster, usage).

Each projection exists twice: as a Spark plan (what the engine runs) and as a DuckDB CTE
(what the correctness oracle runs). Both read the same Parquet tables, so every query's
work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.access import access_state
from adoptlens.operators.enrich import enrich_usage, normalize_events
from adoptlens.sources.tables import table


def _email(key: Column) -> Column:
    return F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com"))


def event_user(key: Column) -> Column:
    """The user of an event; some come from a domain that no roster row has."""
    domain = F.when(key % 13 == 6, "@partner.example").otherwise("@example.com")
    return F.concat(F.lit("user"), key.cast("string"), domain)


def _designation(acctbal: Column) -> Column:
    return F.when(acctbal < 0, "Trainee").when(acctbal < 5000, "Associate").otherwise("Partner")


def _raw_status(k8: Column) -> Column:
    return (F.when(k8 == 4, "Revoked - low usage").when(k8 == 5, "User Resigned")
            .when(k8 == 6, F.lit(None).cast("string")).when(k8 == 7, "Requested").otherwise("Added"))


def roster_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster rows as they arrive from the master file (raw status, no derived state)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    # nation is a fixed 25-row dimension: a proven size bound, safe to broadcast.
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    k = F.col("c_custkey")
    df = c.join(n, F.col("n_nationkey") == F.col("c_nationkey"))
    return df.select(
        _email(k).alias("email"),
        F.col("c_name").alias("workforce_name"),
        F.col("n_name").alias("location"),
        F.when(k % 17 == 3, F.lit("")).when(k % 17 == 4, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("practice"),
        F.when(k % 19 == 5, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("c_mktsegment"), F.lit("-"), (k % 4).cast("string"))).alias("team"),
        _designation(F.col("c_acctbal")).alias("designation"),
        _raw_status(k % 8).alias("raw_status"),
        k.alias("src_ord"),
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster table: one row per e-mail with its derived access state."""
    return roster_source(spark, sf_dir).drop("src_ord").withColumn("access_state", access_state("raw_status"))


def product_area_expr(event_id: Column) -> Column:
    m = event_id % 12
    vals = ["Assistant", "Assistant, Follow-up", "Word Add-In", "Workflow Builder,Review Table",
            "Playbook", "Vault", "Vault, Vault", " , ", "", None, "Knowledge,History,Thread",
            "Research,Translate"]
    expr = F.lit(None).cast("string")
    for i, v in enumerate(vals):
        expr = F.when(m == i, F.lit(v).cast("string")).otherwise(expr)
    return expr


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` presented as flattened raw usage events (before cleaning)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    eid = F.col("event_id")
    return e.select(
        eid.cast("string").alias("usage_id"),
        F.col("ts").alias("utc_time"),
        event_user(F.col("user_id")).alias("user"),
        F.col("event_type").alias("access_point"),
        product_area_expr(eid).alias("product_area"),
        (eid % 4).cast("int").alias("file_count"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched usage table (events + roster snapshot attributes)."""
    return enrich_usage(normalize_events(raw_events(spark, sf_dir)), roster(spark, sf_dir))


# ---------------------------------------------------------------------------------------
# DuckDB mirrors (oracle side). Local zone Asia/Kolkata has no DST: +330 minutes.
# ---------------------------------------------------------------------------------------

ROSTER_SQL = """
roster_src AS (
  SELECT 'user' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
         c.c_name AS workforce_name,
         n.n_name AS location,
         CASE WHEN c.c_custkey % 17 = 3 THEN '' WHEN c.c_custkey % 17 = 4 THEN NULL ELSE c.c_mktsegment END AS practice,
         CASE WHEN c.c_custkey % 19 = 5 THEN NULL ELSE c.c_mktsegment || '-' || CAST(c.c_custkey % 4 AS VARCHAR) END AS team,
         CASE WHEN c.c_acctbal < 0 THEN 'Trainee' WHEN c.c_acctbal < 5000 THEN 'Associate' ELSE 'Partner' END AS designation,
         CASE c.c_custkey % 8 WHEN 4 THEN 'Revoked - low usage' WHEN 5 THEN 'User Resigned' WHEN 6 THEN NULL
              WHEN 7 THEN 'Requested' ELSE 'Added' END AS raw_status,
         CASE c.c_custkey % 8 WHEN 4 THEN 'revoked' WHEN 5 THEN 'resigned' WHEN 6 THEN 'pending'
              WHEN 7 THEN 'pending' ELSE 'granted' END AS access_state,
         c.c_custkey AS src_ord
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
),
roster AS (
  SELECT email, workforce_name, location, practice, team, designation, raw_status, access_state FROM roster_src
)"""

USAGE_SQL = """
usage AS (
  SELECT CAST(e.event_id AS VARCHAR) AS usage_id,
         e.ts AS utc_time,
         CAST(e.ts + INTERVAL '330' MINUTE AS DATE) AS usage_date,
         CAST(EXTRACT(HOUR FROM e.ts + INTERVAL '330' MINUTE) AS INT) AS usage_hour,
         'user' || CAST(e.user_id AS VARCHAR) || CASE WHEN e.user_id % 13 = 6 THEN '@partner.example' ELSE '@example.com' END AS user_email,
         e.event_type AS access_point,
         CASE e.event_id % 12 WHEN 0 THEN 'Assistant' WHEN 1 THEN 'Assistant, Follow-up' WHEN 2 THEN 'Word Add-In'
              WHEN 3 THEN 'Workflow Builder,Review Table' WHEN 4 THEN 'Playbook' WHEN 5 THEN 'Vault'
              WHEN 6 THEN 'Vault, Vault' WHEN 7 THEN ' , ' WHEN 8 THEN '' WHEN 9 THEN NULL
              WHEN 10 THEN 'Knowledge,History,Thread' ELSE 'Research,Translate' END AS product_area,
         CAST(e.event_id % 4 AS INT) AS file_count,
         r.email, r.workforce_name, r.location, r.practice, r.team, r.designation
  FROM events e LEFT JOIN roster r
    ON r.email = 'user' || CAST(e.user_id AS VARCHAR) || CASE WHEN e.user_id % 13 = 6 THEN '@partner.example' ELSE '@example.com' END
)"""


def with_fixtures(body: str, usage_needed: bool = True, extra: tuple[str, ...] = ()) -> str:
    """Prefix an oracle statement with the roster (and usage, and extra) CTEs."""
    ctes = [ROSTER_SQL.strip()]
    if usage_needed:
        ctes.append(USAGE_SQL.strip())
    ctes.extend(e.strip() for e in extra)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def roster_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster file with duplicate e-mails: customers with c_custkey % 5 = 0 appear again right
    after their first row (ordinal 2k+1), with another status, a filled practice and a blank
    team. Columns as ``roster`` plus ``src_ord``."""
    base = roster_source(spark, sf_dir)
    orig = base.withColumn("src_ord", F.col("src_ord") * 2)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    k = F.col("c_custkey")
    shifted = (k + 3) % 8
    copies = c.filter(k % 5 == 0).join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(
        _email(k).alias("email"),
        F.col("c_name").alias("workforce_name"),
        F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("practice"),
        F.lit("").alias("team"),
        _designation(F.col("c_acctbal")).alias("designation"),
        _raw_status(shifted).alias("raw_status"),
        (k * 2 + 1).alias("src_ord"),
    )
    return orig.unionByName(copies).withColumn("access_state", access_state("raw_status"))


COPIES_SQL = """
roster_copies AS (
  SELECT email, workforce_name, location, practice, team, designation, raw_status, access_state, src_ord * 2 AS src_ord
  FROM roster_src
  UNION ALL
  SELECT 'user' || CAST(c.c_custkey AS VARCHAR) || '@example.com', c.c_name, n.n_name, c.c_mktsegment, '',
         CASE WHEN c.c_acctbal < 0 THEN 'Trainee' WHEN c.c_acctbal < 5000 THEN 'Associate' ELSE 'Partner' END,
         CASE (c.c_custkey + 3) % 8 WHEN 4 THEN 'Revoked - low usage' WHEN 5 THEN 'User Resigned' WHEN 6 THEN NULL
              WHEN 7 THEN 'Requested' ELSE 'Added' END,
         CASE (c.c_custkey + 3) % 8 WHEN 4 THEN 'revoked' WHEN 5 THEN 'resigned' WHEN 6 THEN 'pending'
              WHEN 7 THEN 'pending' ELSE 'granted' END,
         c.c_custkey * 2 + 1
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE c.c_custkey % 5 = 0
)"""
