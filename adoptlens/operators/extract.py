"""Enriched extract (CSV headers, all text) -> canonical usage rows.

Each canonical column takes the first alias column *present* in the extract — as in the
reference, where a missing value does not fall through to the next alias, only a missing
column does — then strip + blank->NULL; numbers and dates are coerced leniently. Rows
without key or user are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ, local_date, local_hour, parse_utc_text
from adoptlens.functions.coerce import lenient_date
from adoptlens.functions.text import clean_text, normalize_email

# Extract header aliases per canonical column, in preference order.
ALIASES = {
    "usage_id": ["unique_usage_id"],
    "user_email": ["user", "user_email", "Email"],
    "workforce_id": ["Workforce Id", "workforce_id"],
    "workforce_name": ["Workforce Name", "workforce_name"],
    "location": ["Location", "location"],
    "designation": ["Designation", "designation"],
    "team": ["Team", "team"],
    "practice": ["Practice/ Function", "practice_function", "practice"],
    "reporting_manager_name": ["Reporting Manager Name", "reporting_manager_name"],
    "email": ["Email", "email"],
    "product_area": ["product_surface_area", "product_area"],
}
EVENT_TEXT = ["access_point", "action", "workflow_name", "source", "subsurface", "cm_id", "parent_thread_id",
              "space_name", "playbook_name", "vault_project_name", "review_table_name"]
_WHOLE = r"^[+-]?[0-9]+(\.0*)?$"  # '5' and '5.0' (a float column written by pandas) are whole numbers


def _first_present(df: DataFrame, names: list[str]) -> Column | None:
    for n in names:
        if n in df.columns:
            return F.col(f"`{n}`")
    return None


def _whole_number(c: Column, default: int | None) -> Column:
    s = clean_text(c)
    v = F.when(s.rlike(_WHOLE), s.try_cast("double").try_cast("int"))
    return F.coalesce(v, F.lit(default).cast("int")) if default is not None else v


def canonical_usage(extract: DataFrame, tz: str = DEFAULT_TZ, keep: list[str] | None = None) -> DataFrame:
    """Canonical usage rows; ``keep`` names extra input columns carried through unchanged."""
    df = extract.toDF(*[c.strip().lstrip("﻿") for c in extract.columns])
    null = F.lit(None).cast("string")
    pick = {k: _first_present(df, v) for k, v in ALIASES.items()}
    user = normalize_email(pick["user_email"]) if pick["user_email"] is not None else null
    ts = parse_utc_text(F.col("utc_time")) if "utc_time" in df.columns else F.lit(None).cast("timestamp_ntz")
    date_col = lenient_date("usage_date") if "usage_date" in df.columns else local_date(ts, tz)
    hour_col = _whole_number(F.col("usage_hour"), None) if "usage_hour" in df.columns else local_hour(ts, tz)
    cols = [
        clean_text(pick["usage_id"]).alias("usage_id") if pick["usage_id"] is not None else null.alias("usage_id"),
        ts.alias("utc_time"),
        date_col.alias("usage_date"),
        hour_col.cast("int").alias("usage_hour"),
        user.alias("user_email"),
        *[(clean_text(c) if c in df.columns else null).alias(c) for c in EVENT_TEXT],
        (clean_text(pick["product_area"]) if pick["product_area"] is not None else null).alias("product_area"),
        (_whole_number(F.col("file_count"), 0) if "file_count" in df.columns else F.lit(0)).alias("file_count"),
    ]
    for k in ["workforce_id", "workforce_name", "location", "designation", "team", "practice",
              "reporting_manager_name"]:
        cols.append((clean_text(pick[k]) if pick[k] is not None else null).alias(k))
    cols.append((lenient_date(F.col("`Date of Joining`")) if "Date of Joining" in df.columns
                 else F.lit(None).cast("date")).alias("date_of_joining"))
    email = clean_text(pick["email"]) if pick["email"] is not None else user
    cols.append(email.alias("email"))
    cols.extend(F.col(k) for k in (keep or []))
    out = df.select(*cols)
    return out.filter(F.col("usage_id").isNotNull() & F.col("user_email").isNotNull())
