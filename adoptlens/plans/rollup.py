"""Usage rollup: the events table pre-aggregated for reporting.

One hash-aggregated pass (map-side combined, so a hot user is reduced before the shuffle)
turns events into one row per (local day, user, roster attributes, access point, tool
list) with the event count ``_n`` and file sum ``_files``. Every dashboard, leaderboard,
filter-option, adoption and team-report section is exact on it: counts and sums are
additive, distinct values survive, tool mentions are weighted by ``_n``. Only the detail
page and the exports need raw rows. The report functions accept either frame (see
``rows`` / ``files``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptlens.session import scratch_path

WEIGHT = "_n"
FILES = "_files"
ROLLUP_KEYS = ["usage_date", "user_email", "email", "workforce_name", "practice", "team", "location",
               "designation", "access_point", "product_area"]


def is_rollup(df: DataFrame) -> bool:
    return WEIGHT in df.columns


def rows(df: DataFrame) -> Column:
    """Aggregate expression: number of underlying events."""
    # coalesce: over no rows count(*) is 0 while sum() is NULL
    return F.coalesce(F.sum(WEIGHT), F.lit(0)).cast("bigint") if is_rollup(df) else F.count(F.lit(1))


def rows_if(df: DataFrame, cond: Column) -> Column:
    """Number of underlying events satisfying ``cond``."""
    if is_rollup(df):
        return F.coalesce(F.sum(F.when(cond, F.col(WEIGHT))), F.lit(0)).cast("bigint")
    return F.count_if(cond)


def weight(df: DataFrame) -> Column:
    """Per-row multiplicity (1 for raw events)."""
    return F.col(WEIGHT) if is_rollup(df) else F.lit(1)


def files(df: DataFrame) -> Column:
    """Aggregate expression: total attached files (NULL when no rows)."""
    return F.sum(FILES) if is_rollup(df) else F.sum("file_count")


def stored_rollup(usage: DataFrame) -> DataFrame:
    """The rollup of ``usage`` as a table in the shared folder: the one scan of the raw events
    from which all sections of a report are read. A rollup is taken as it is."""
    if is_rollup(usage):
        return usage
    path = scratch_path(usage.sparkSession, "rollup")
    rolled = usage_rollup(usage)
    rolled.write.parquet(path)
    return usage.sparkSession.read.schema(rolled.schema).parquet(path)


def usage_rollup(usage: DataFrame) -> DataFrame:
    keys = [k for k in ROLLUP_KEYS if k in usage.columns]
    return usage.groupBy(*keys).agg(F.count(F.lit(1)).alias(WEIGHT),
                                    F.sum("file_count").cast("bigint").alias(FILES))
