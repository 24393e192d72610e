"""Team / practice report over a date window.

Roster scope uses current roster attributes; usage scope uses the attributes copied onto
each event at ingest — a transferred person can appear on one side only, as in the
reference. Per-user feature counts come from one aggregation over the usage scope:
each event's tool list is classified in place (higher-order functions), so there is no
explode -> group -> join round trip.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ
from adoptlens.functions.access import GRANTED, PENDING, RESIGNED, REVOKED, status_note
from adoptlens.functions.features import FEATURE_KEYS, FEATURES, feature_class, tool_array
from adoptlens.functions.numeric import pct, ratio
from adoptlens.plans.dashboard import DASH
from adoptlens.plans.rollup import rows, stored_rollup, weight

# Shown with every report.
DISCLAIMER = ("An event that names several tools is one event in the total but counts once for each "
              "feature, so the feature counts need not add up to the total.")


# Fixed value: tools without a feature that the report's head names, as in the reference.
UNMAPPED_SHOWN = 50


def validate(practice: str | None, start, end) -> None:
    if practice is None or not str(practice).strip():
        raise ValueError("Practice is required")
    if start is None or end is None:
        raise ValueError("Start date and end date are required")


def _date(d):
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def _team_set(team: str | None) -> bool:
    return team is not None and team.strip() != ""


def roster_scope(roster: DataFrame, practice: str, team: str | None = None) -> DataFrame:
    r = roster.filter(F.col("practice") == practice)
    return r.filter(F.col("team") == team) if _team_set(team) else r


def usage_scope(usage: DataFrame, practice: str, team: str | None, start, end, tz: str = DEFAULT_TZ) -> DataFrame:
    u = usage.filter((F.col("practice") == practice) & F.col("user_email").isNotNull())
    if _team_set(team):
        u = u.filter(F.col("team") == team)
    s, e = _date(start), _date(end)
    u = u.filter((F.col("usage_date") >= F.lit(s)) & (F.col("usage_date") <= F.lit(e)))
    if "utc_time" in usage.columns:  # same bounds on the stored instant (Parquet pushdown)
        from adoptlens.functions.calendar import window_predicate
        u = u.filter(window_predicate("utc_time", s, e + dt.timedelta(days=1), tz))
    return u


def _feature_array():
    return F.transform(tool_array("product_area"), lambda t: feature_class(t))


def _mentions(feats, key: str):
    """Number of elements of the classified tool array equal to ``key``."""
    return F.size(F.filter(feats, lambda c: c == F.lit(key)))


def user_features(usage_f: DataFrame) -> DataFrame:
    """Per user: total events and mentions per feature (one partial-aggregated pass)."""
    feats = _feature_array()
    w = weight(usage_f)
    aggs = [rows(usage_f).alias("total_activity")]
    for key in FEATURE_KEYS:
        aggs.append(F.sum(_mentions(feats, key) * w).cast("bigint").alias(key))
    return usage_f.groupBy("user_email").agg(*aggs)


def usage_by_feature(usage_f: DataFrame) -> DataFrame:
    """Long form (user, feature_key, cnt), unmapped tools as NULL feature."""
    ex = usage_f.select("user_email", F.explode(tool_array("product_area")).alias("tool"),
                        weight(usage_f).alias("_w"))
    return ex.groupBy("user_email", feature_class("tool").alias("feature_key")).agg(
        F.sum("_w").cast("bigint").alias("cnt"))


def feature_totals(usage_f: DataFrame) -> DataFrame:
    """(sort_order, key, label, count) in the report's fixed order."""
    feats = _feature_array()
    w = weight(usage_f)
    one = usage_f.agg(*[
        F.coalesce(F.sum(_mentions(feats, key) * w), F.lit(0)).cast("bigint").alias(key)
        for key in FEATURE_KEYS
    ])
    rows = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("sort_order"), F.lit(k).alias("key"), F.lit(label).alias("label"),
                 F.col(k).alias("count"))
        for i, (k, label) in enumerate(FEATURES)
    ])).alias("f")
    return one.select(rows).select("f.*")


def report_members(hr_base: DataFrame, uf: DataFrame) -> DataFrame:
    """Granted members with activity and feature counts (0 when none), busiest first."""
    g = hr_base.filter(F.col("access_state") == GRANTED)
    j = g.join(uf, g["email"] == uf["user_email"], "left")
    cols = [
        F.coalesce(g["workforce_name"], F.lit(DASH)).alias("name"),
        F.coalesce(g["designation"], F.lit(DASH)).alias("designation"),
        g["email"].alias("user_email"),
        F.coalesce(g["raw_status"], F.lit("Added")).alias("status"),
        F.coalesce(g["team"], F.lit(DASH)).alias("team"),
        F.coalesce(uf["total_activity"], F.lit(0)).cast("bigint").alias("total_activity"),
    ] + [F.coalesce(uf[k], F.lit(0)).cast("bigint").alias(k) for k in FEATURE_KEYS]
    return j.select(*cols).orderBy(F.desc("total_activity"), F.asc("name"), F.asc("user_email"))


def report_summary(hr_base: DataFrame, uf: DataFrame, usage_f: DataFrame) -> DataFrame:
    st = F.col("access_state")
    j = hr_base.join(uf, hr_base["email"] == uf["user_email"], "left")
    act = F.coalesce(uf["total_activity"], F.lit(0))
    granted = st == GRANTED
    # top member: highest activity, then name — min over (-activity, name)
    top_key = F.when(granted, F.struct((-act).alias("neg"), F.coalesce(hr_base["workforce_name"], F.lit(DASH)).alias("name")))
    people = j.agg(
        F.count_if(st != RESIGNED).alias("total_members"),
        F.count_if(granted).alias("with_access"),
        F.count_if(granted & (act > 0)).alias("members_active"),
        F.count_if(granted & (act == 0)).alias("not_used"),
        F.min(top_key).alias("top"),
        F.count_if(st == PENDING).alias("access_pending"),
        F.count_if(st == REVOKED).alias("revoked_count"),
        F.count_if(st == RESIGNED).alias("resigned_count"),
        F.count_if(st.isin(GRANTED, PENDING)).alias("workforce"),
    )
    total = usage_f.agg(F.coalesce(rows(usage_f), F.lit(0)).cast("bigint").alias("total_activity"))
    s = people.crossJoin(F.broadcast(total))  # both sides are single-row aggregates
    return s.select(
        "total_members", "with_access", "members_active", "not_used", "total_activity",
        F.coalesce(F.col("top.name"), F.lit(DASH)).alias("top_user_name"),
        F.coalesce(-F.col("top.neg"), F.lit(0)).cast("bigint").alias("top_user_actions"),
        pct(F.col("members_active"), F.col("with_access")).alias("adoption_rate"),
        F.col("not_used").alias("inactive_count"),
        "access_pending",
        ratio(F.col("total_activity"), F.col("members_active")).alias("avg_actions_per_active"),
        "revoked_count", "resigned_count",
        pct(F.col("with_access"), F.col("workforce")).alias("access_coverage_pct"),
    )


def report_without_access(hr_base: DataFrame) -> DataFrame:
    w = hr_base.filter(~F.col("access_state").eqNullSafe(GRANTED))
    return w.orderBy(F.asc_nulls_last("workforce_name"), F.asc("email")).select(
        F.coalesce("workforce_name", F.lit(DASH)).alias("name"),
        F.coalesce("designation", F.lit(DASH)).alias("designation"),
        "email",
        status_note("raw_status", "access_state").alias("status_note"),
    )


def unmapped_tools(usage_f: DataFrame) -> DataFrame:
    """Distinct tools that no feature class takes."""
    ex = usage_f.select(F.explode(tool_array("product_area")).alias("tool"))
    return ex.filter(feature_class("tool").isNull()).distinct().orderBy("tool")


def report_meta(spark: SparkSession, usage_f: DataFrame, practice: str, team: str | None, start, end,
                generated_at: bool = False) -> DataFrame:
    s, e = _date(start), _date(end)
    scope = "team" if _team_set(team) else "practice"
    title = f"{team} — Summary" if scope == "team" else f"{practice} — Summary (All Teams)"
    shown = unmapped_tools(usage_f).limit(UNMAPPED_SHOWN)  # in their order; ``unmapped_tools`` has all of them
    unm = shown.agg(F.to_json(F.array_sort(F.collect_list("tool"))).alias("unmapped_features"))
    meta = spark.range(1).select(
        F.lit(practice).alias("practice"),
        F.lit(team).cast("string").alias("team"),
        F.lit(scope).alias("scope"),
        F.lit(s).alias("start_date"),
        F.lit(e).alias("end_date"),
        F.concat(F.date_format(F.lit(s), "dd MMM yyyy"), F.lit(" – "), F.date_format(F.lit(e), "dd MMM yyyy")).alias("period_label"),
        F.lit(title).alias("title"),
        F.lit(DISCLAIMER).alias("disclaimer"),
    )
    if generated_at:
        meta = meta.withColumn("generated_at", F.concat(
            F.date_format(F.convert_timezone(F.lit(spark.conf.get("spark.sql.session.timeZone")), F.lit("Asia/Kolkata"),
                                        F.current_timestamp().cast("timestamp_ntz")),
                          "yyyy-MM-dd HH:mm:ss"), F.lit(" IST")))
    return meta.crossJoin(F.broadcast(unm))


def build(spark: SparkSession, roster: DataFrame, usage: DataFrame, practice: str, team: str | None,
          start, end, tz: str = DEFAULT_TZ) -> dict[str, DataFrame]:
    """All sections of the report; the events in scope are scanned once, into a rollup."""
    validate(practice, start, end)
    hr = roster_scope(roster, practice, team)
    uf_scope = stored_rollup(usage_scope(usage, practice, team, start, end, tz))
    uf = user_features(uf_scope)
    return {
        "meta": report_meta(spark, uf_scope, practice, team, start, end, generated_at=True),
        "summary": report_summary(hr, uf, uf_scope),
        "features": feature_totals(uf_scope),
        "members_with_access": report_members(hr, uf),
        "members_without_access": report_without_access(hr),
    }
