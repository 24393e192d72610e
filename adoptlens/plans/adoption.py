"""Adoption bundle: roster (current attributes) x usage activity.

Activity is reduced to one row per user with a single partially-aggregated pass over
usage (events in the period, events ever); the roster then joins that per-person frame
once. Every metric below is a conditional count over the enriched roster — one scan
replaces the reference's five-branch funnel and its two activity joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.functions.access import GRANTED, PENDING, RESIGNED, REVOKED
from adoptlens.functions.numeric import pct, ratio
from adoptlens.operators.filters import ROSTER_DIMS, Filters, _as_date, non_blank
from adoptlens.plans.dashboard import DASH
from adoptlens.plans.rollup import rows, rows_if
from adoptlens.session import scratch_path

# Funnel labels.
FUNNEL = [
    (1, "Access Pending"),
    (2, "Active (with access)"),
    (3, "Inactive (with access)"),
    (4, "Revoked"),
    (5, "Resigned"),
]


def user_activity(usage: DataFrame, filters: Filters | None = None) -> DataFrame:
    """Per user: events inside the date window and events ever (NULL users dropped)."""
    f = filters or Filters()
    start, end = _as_date(f.start_date), _as_date(f.end_date)
    in_period = F.lit(True)
    if start is not None:
        in_period = in_period & (F.col("usage_date") >= F.lit(start))
    if end is not None:
        in_period = in_period & (F.col("usage_date") <= F.lit(end))
    return (
        usage.filter(F.col("user_email").isNotNull())
        .groupBy("user_email")
        .agg(rows_if(usage, F.coalesce(in_period, F.lit(False))).alias("period_events"),
             rows(usage).alias("events"))
    )


def roster_activity(roster: DataFrame, usage: DataFrame, filters: Filters | None = None) -> DataFrame:
    """Filtered roster + is_active (used in the window) + has_ever_used + period_events."""
    f = filters or Filters()
    r = f.without("dates", "products", "accesses", "search").apply(roster, ROSTER_DIMS, instant_col=None)
    act = user_activity(usage, f)
    j = r.join(act, r["email"] == act["user_email"], "left")
    return j.select(
        *[r[c] for c in r.columns],
        (F.coalesce(act["period_events"], F.lit(0)) > 0).alias("is_active"),
        act["user_email"].isNotNull().alias("has_ever_used"),
        F.coalesce(act["period_events"], F.lit(0)).alias("period_events"),
    )


def _st(name: str):
    return F.col("access_state") == name


def adoption_kpis(enriched: DataFrame) -> DataFrame:
    granted = _st(GRANTED)
    active = granted & F.col("is_active")
    counts = enriched.agg(
        F.count_if(F.col("access_state").isin(GRANTED, PENDING)).alias("total_workforce"),
        F.count_if(granted).alias("access_granted"),
        F.count_if(_st(PENDING)).alias("access_pending"),
        F.count_if(active).alias("active_users"),
        F.count_if(granted & ~F.col("is_active")).alias("inactive_users"),
        F.count_if(_st(REVOKED)).alias("revoked_count"),
        F.count_if(_st(RESIGNED)).alias("resigned_count"),
        F.count_if(granted & ~F.col("has_ever_used")).alias("never_used_lifetime"),
        # events in the window by granted, active people (the reference's IN-subquery)
        F.coalesce(F.sum(F.when(active, F.col("period_events"))), F.lit(0)).alias("period_actions"),
    )
    return counts.select(
        "*",
        pct(F.col("active_users"), F.col("access_granted")).alias("adoption_rate"),
        ratio(F.col("period_actions"), F.col("active_users")).alias("avg_actions_per_active"),
    ).drop("period_actions")


def _ranked(df: DataFrame, k: int | None) -> DataFrame:
    """All groups, highest value first; the first ``k`` of them where a caller asks for it."""
    out = df.orderBy(F.desc("value"), F.asc("label"))
    return out if k is None else out.limit(k)


def team_access_coverage(enriched: DataFrame, k: int | None = None) -> DataFrame:
    g = enriched.filter(non_blank("team")).groupBy(F.col("team").alias("label")).agg(
        F.count_if(_st(GRANTED)).alias("granted"),
        F.count_if(F.col("access_state").isin(GRANTED, PENDING)).alias("workforce"),
    )
    g = g.filter(F.col("workforce") > 0)
    return _ranked(g.select("label", pct(F.col("granted"), F.col("workforce"), zero_when_empty=False).alias("value")), k)


def team_adoption_rate(enriched: DataFrame, k: int | None = None) -> DataFrame:
    g = enriched.filter(_st(GRANTED) & non_blank("team")).groupBy(F.col("team").alias("label")).agg(
        F.count_if(F.col("is_active")).alias("active"), F.count(F.lit(1)).alias("granted")
    )
    g = g.filter(F.col("granted") > 0)
    return _ranked(g.select("label", pct(F.col("active"), F.col("granted"), zero_when_empty=False).alias("value")), k)


def practice_access_coverage(enriched: DataFrame, k: int | None = None) -> DataFrame:
    """Like team coverage, plus groups whose rounded value is 0 are dropped."""
    g = (
        enriched.filter(F.col("access_state").isin(GRANTED, PENDING) & non_blank("practice"))
        .groupBy(F.col("practice").alias("label"))
        .agg(F.count_if(_st(GRANTED)).alias("granted"), F.count(F.lit(1)).alias("workforce"))
    )
    v = g.filter(F.col("workforce") > 0).select(
        "label", pct(F.col("granted"), F.col("workforce"), zero_when_empty=False).alias("value"))
    return _ranked(v.filter(F.col("value") > 0), k)


def access_funnel(enriched: DataFrame) -> DataFrame:
    """Five ordered stages from one aggregate row (unpivot), zero stages dropped."""
    granted = _st(GRANTED)
    one = enriched.agg(
        F.count_if(_st(PENDING)).alias("s1"),
        F.count_if(granted & F.col("is_active")).alias("s2"),
        F.count_if(granted & ~F.col("is_active")).alias("s3"),
        F.count_if(_st(REVOKED)).alias("s4"),
        F.count_if(_st(RESIGNED)).alias("s5"),
    )
    stages = F.explode(F.array(*[
        F.struct(F.lit(i).alias("stage"), F.lit(label).alias("label"), F.col(f"s{i}").alias("value"))
        for i, label in FUNNEL
    ])).alias("s")
    return one.select(stages).select("s.stage", "s.label", "s.value").filter(F.col("value") > 0).orderBy("stage")


def _people(df: DataFrame, cols, k: int | None) -> DataFrame:
    out = df.orderBy(F.asc_nulls_last("workforce_name"), F.asc("email"))
    return (out if k is None else out.limit(k)).select(*cols)


def inactive_members(enriched: DataFrame, k: int | None = None) -> DataFrame:
    cols = [F.coalesce("workforce_name", F.lit(DASH)).alias("name"), "email",
            F.coalesce("team", F.lit(DASH)).alias("team"),
            F.coalesce("designation", F.lit(DASH)).alias("designation"),
            F.coalesce("location", F.lit(DASH)).alias("location")]
    for opt in ("date_added", "low_usage_warning"):
        if opt in enriched.columns:
            cols.append(opt)
    return _people(enriched.filter(_st(GRANTED) & ~F.col("is_active")), cols, k)


def pending_members(enriched: DataFrame, k: int | None = None) -> DataFrame:
    cols = [F.coalesce("workforce_name", F.lit(DASH)).alias("name"), "email",
            F.coalesce("team", F.lit(DASH)).alias("team"),
            F.coalesce("practice", F.lit(DASH)).alias("practice"),
            F.coalesce("designation", F.lit(DASH)).alias("designation")]
    return _people(enriched.filter(_st(PENDING)), cols, k)


def revoked_members(enriched: DataFrame, k: int | None = None) -> DataFrame:
    cols = [F.coalesce("workforce_name", F.lit(DASH)).alias("name"), "email",
            F.coalesce("team", F.lit(DASH)).alias("team"),
            F.coalesce("raw_status", F.lit(DASH)).alias("status")]
    return _people(enriched.filter(_st(REVOKED)), cols, k)


def adoption_filter_options(roster: DataFrame) -> DataFrame:
    """(dimension, parent, value): practices, locations, designations, and teams under practice."""
    flat = roster.select(F.explode(F.array(
        F.struct(F.lit("practices").alias("dimension"), F.lit(None).cast("string").alias("parent"),
                 F.col("practice").alias("value")),
        F.struct(F.lit("locations").alias("dimension"), F.lit(None).cast("string").alias("parent"),
                 F.col("location").alias("value")),
        F.struct(F.lit("designations").alias("dimension"), F.lit(None).cast("string").alias("parent"),
                 F.col("designation").alias("value")),
        F.struct(F.lit("teams").alias("dimension"), F.when(non_blank("practice"), F.col("practice")).alias("parent"),
                 F.when(non_blank("practice"), F.col("team")).alias("value")),
    )).alias("o")).select("o.dimension", "o.parent", "o.value")
    return flat.filter(non_blank("value")).distinct().orderBy("dimension", "parent", "value")


#: Sections of ``bundle``.
SECTIONS = ("kpis", "team_access_coverage", "team_adoption_rate", "practice_access_coverage", "access_funnel", "inactive_users",
            "pending_access", "revoked_users")


def bundle(roster: DataFrame, usage: DataFrame, filters: Filters | None = None) -> dict[str, DataFrame]:
    """All sections; usage is scanned and joined once, into one stored row per person."""
    people = roster_activity(roster, usage, filters)
    path = scratch_path(roster.sparkSession, "people")
    people.write.parquet(path)
    e = roster.sparkSession.read.schema(people.schema).parquet(path)
    return {
        "kpis": adoption_kpis(e),
        "team_access_coverage": team_access_coverage(e),
        "team_adoption_rate": team_adoption_rate(e),
        "practice_access_coverage": practice_access_coverage(e),
        "access_funnel": access_funnel(e),
        "inactive_users": inactive_members(e),
        "pending_access": pending_members(e),
        "revoked_users": revoked_members(e),
    }
