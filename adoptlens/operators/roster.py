"""Roster import: cleaning, access state, duplicate merge with gap filling, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.access import STATES, access_state, state_rank
from adoptlens.functions.coerce import day_first_date, lenient_date
from adoptlens.functions.text import clean_text, normalize_email
from adoptlens.operators.dedupe import keep_first, merge_newer

# Roster file headers -> roster columns.
FILE_COLUMNS = {
    "Email": "email",
    "Workforce Id": "workforce_id",
    "Workforce Name": "workforce_name",
    "Location": "location",
    "Date of Joining": "date_of_joining",
    "Designation": "designation",
    "Team": "team",
    "Practice/ Function": "practice",
    "Reporting Manager Name": "reporting_manager_name",
    "Status": "raw_status",
    "Phase": "phase",
    "Low usage warning": "low_usage_warning",
    "Date Added": "date_added",
    "Training Attendance": "training_attendance",
    "Cohort Training Attendance": "cohort_training_attendance",
    "Notes": "notes",
}
ROSTER_FIELDS = ["workforce_name", "location", "practice", "team", "designation", "raw_status"]


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def records_from_file(raw: DataFrame, ord_col: str | None = None) -> DataFrame:
    """Roster file (all string columns, any header padding) -> cleaned roster records.

    Blank text becomes NULL, e-mails are lower-cased, dates parsed leniently ('Date Added'
    day-first), rows without e-mail dropped, access state derived (no status column at
    all means granted).
    """
    df = trim_headers(raw)
    has_status = "Status" in df.columns
    cols = []
    for src, dst in FILE_COLUMNS.items():
        if src not in df.columns:
            cols.append(F.lit(None).cast("date" if dst in ("date_of_joining", "date_added") else "string").alias(dst))
        elif dst == "email":
            cols.append(normalize_email(src).alias(dst))
        elif dst == "date_of_joining":
            cols.append(lenient_date(src).alias(dst))
        elif dst == "date_added":
            cols.append(day_first_date(src).alias(dst))
        else:
            cols.append(clean_text(src).alias(dst))
    if ord_col:
        cols.append(F.col(ord_col))
    out = df.select(*cols).filter(F.col("email").isNotNull())
    return out.withColumn("access_state", access_state("raw_status", has_status_column=has_status))


def _nb(c):
    """Value if non-blank, else NULL (blank = NULL or empty text)."""
    return F.when(c.isNotNull() & (c.cast("string") != ""), c)


def merge_duplicates(df: DataFrame, ord_col: str, fields: Sequence[str] = ROSTER_FIELDS,
                     key: str = "email") -> DataFrame:
    """Merge rows sharing an e-mail, equal to folding them in file order where a row with a
    strictly higher state rank (granted > revoked > resigned > pending) takes over and
    blank fields are filled from the others.

    Set form: the take-over rows ("records") are exactly the first row reaching each rank
    threshold k; field precedence is records newest-first, then other rows oldest-first.
    Everything is one grouped aggregation with FILTER-style ``min_by`` — partial
    aggregation keeps it linear and skew-safe, no window over a key.
    """
    rank = state_rank("access_state")
    row = F.struct(*[F.col(f) for f in fields], F.col("access_state"))
    aggs = [F.min_by(row, F.col(ord_col)).alias("rec0")]
    for k in (1, 2, 3, 4):
        aggs.append(F.min_by(row, F.when(rank >= k, F.col(ord_col))).alias(f"rec{k}"))
    for f in fields:
        aggs.append(F.min_by(F.col(f), F.when(_nb(F.col(f)).isNotNull(), F.col(ord_col))).alias(f"first_{f}"))
    g = df.groupBy(key).agg(*aggs)
    recs = [F.col(f"rec{k}") for k in (4, 3, 2, 1, 0)]  # newest record first
    out = [F.col(key)]
    for f in fields:
        out.append(F.coalesce(*[_nb(r[f]) for r in recs], F.col(f"first_{f}")).alias(f))
    out.append(F.coalesce(*[r["access_state"] for r in recs]).alias("access_state"))
    return g.select(*out)


def duplicate_emails(df: DataFrame, key: str = "email") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def state_counts(spark: SparkSession, roster: DataFrame) -> DataFrame:
    """Rows per access state, zero-filled over the four states (4-row broadcast spine)."""
    counts = roster.groupBy("access_state").agg(F.count(F.lit(1)).alias("n"))
    spine = F.broadcast(spark.createDataFrame([(s,) for s in STATES], "access_state string"))
    return spine.join(counts, "access_state", "left").select(
        "access_state", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "email") -> DataFrame:
    """Keyed upsert: an incoming row replaces the stored row; people absent from the
    incoming file are kept."""
    return merge_newer(existing, incoming, [key], [])


def roster_from_usage(usage: DataFrame, order_cols: Sequence[str] = ("utc_time", "usage_id")) -> DataFrame:
    """Bootstrap a roster from matched events: first row per roster e-mail; no status
    column, so everyone is granted."""
    cols = ["email", "workforce_name", "location", "designation", "team", "practice"]
    src = usage.filter(F.col("email").isNotNull()).select(*cols, *order_cols)
    first = keep_first(src, ["email"], list(order_cols)).select(*cols)
    return first.withColumn("access_state", F.lit("granted"))
