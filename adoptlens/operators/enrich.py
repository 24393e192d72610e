"""Event normalisation and roster enrichment (the write path of the daily sync)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ, local_date, local_hour
from adoptlens.functions.text import clean_text, normalize_email

# Roster attributes copied onto each event at ingest (a denormalised snapshot).
ROSTER_ATTRS = ["workforce_id", "workforce_name", "location", "designation", "team", "practice",
                "reporting_manager_name", "date_of_joining"]


def normalize_events(raw: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """Clean flattened events: key and user normalised, keyless rows dropped, local day/hour.

    ``raw`` needs ``usage_id``, ``user`` and ``utc_time`` (UTC, timestamp); other event
    columns pass through.
    """
    df = (
        raw.withColumn("usage_id", clean_text("usage_id"))
        .withColumn("user_email", normalize_email("user"))
        .drop("user")
    )
    df = df.filter(F.col("usage_id").isNotNull() & F.col("user_email").isNotNull())
    return df.withColumn("usage_date", local_date("utc_time", tz)).withColumn(
        "usage_hour", local_hour("utc_time", tz)
    )


def enrich_usage(events: DataFrame, roster: DataFrame) -> DataFrame:
    """Left join events to the (e-mail keyed, de-duplicated) roster.

    ``email`` is the matched roster e-mail only (NULL when unmatched), as in the reference.
    No hint: a roster under the session's broadcast threshold is broadcast, by statistics or
    by the size AQE measures; beyond it a sort-merge join has its skewed users split.
    """
    attrs = [c for c in ROSTER_ATTRS if c in roster.columns]
    r = roster.select(F.col("email").alias("_r_email"), *attrs)
    ev_cols = [c for c in events.columns if c not in attrs and c != "email"]
    joined = events.select(*ev_cols).join(r, F.col("user_email") == F.col("_r_email"), "left")
    return joined.withColumnRenamed("_r_email", "email")


def match_audit(usage: DataFrame) -> DataFrame:
    """Matched / unmatched counts (by NULL workforce name) and the extract's date range."""
    from adoptlens.plans.rollup import rows, rows_if

    return usage.agg(
        rows(usage).alias("rows"),
        rows_if(usage, F.col("workforce_name").isNotNull()).alias("matched"),
        rows_if(usage, F.col("workforce_name").isNull()).alias("unmatched"),
        F.min("usage_date").alias("min_date"),
        F.max("usage_date").alias("max_date"),
    )


def unmatched_events(usage: DataFrame) -> DataFrame:
    """Reject rows: events whose user matched no roster name."""
    return usage.filter(F.col("workforce_name").isNull())
