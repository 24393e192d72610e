"""Whole report bundles in long form (section, label, value), so that one key covers all sections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.catalog import ORACLES, register
from adoptlens.catalog import adoption_q, dashboard_q, report_q  # noqa: F401  (their oracles come first)
from adoptlens.plans import adoption as A
from adoptlens.plans import dashboard as D
from adoptlens.plans import team_report as T
from adoptlens.sources import fixtures as fx

W = fx.with_fixtures


def _row(section: str, df: DataFrame) -> DataFrame:
    """The numbers of a one-row section, one row each."""
    numbers = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("string", "date")]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("double").alias("value")) for c in numbers])).alias("x")
    return df.select(each).select(F.lit(section).alias("section"), "x.label", "x.value")


def _chart(section: str, df: DataFrame, label: str = "label", value: str = "value") -> DataFrame:
    return df.select(F.lit(section).alias("section"), F.col(label).alias("label"), F.col(value).cast("double").alias("value"))


def _people(section: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(section).alias("section"), F.col("email").alias("label"), F.lit(1.0).alias("value"))


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _chart_sql(section: str, body: str, label: str = "label", value: str = "value") -> str:
    return f"SELECT '{section}' AS section, {label} AS label, CAST({value} AS DOUBLE) AS value FROM ({body})"


def _row_sql(section: str, body: str, names: list[str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{section}' AS section, '{n}' AS label, CAST({n} AS DOUBLE) AS value FROM ({body})" for n in names)


def _own(key: str) -> str:
    """A registered oracle as a subquery: it brings its own fixtures."""
    return ORACLES[key].rstrip(";")


_F = "WHERE " + dashboard_q.FILTERED_SQL
_TOOLS_SQL = f"""
WITH t AS (SELECT trim(unnest(string_split(COALESCE(product_area, ''), ','))) AS tool FROM usage {_F}),
c AS (SELECT tool, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, tool) AS place FROM t WHERE tool <> '' GROUP BY tool)
SELECT CASE WHEN place <= 8 THEN tool ELSE 'Other' END AS label, SUM(n) AS value FROM c GROUP BY 1"""
_DASHBOARD_SQL = "\nUNION ALL ".join([
    _row_sql("kpis", dashboard_q.KPIS_SQL.format(where=_F), ["active_users", "total_actions", "practice_areas"]),
    _chart_sql("timeline", f"SELECT strftime(usage_date, '%Y-%m-%d') AS label, COUNT(*) AS value FROM usage {_F} GROUP BY 1"),
    *[_chart_sql(c, dashboard_q._count_by_sql(c, _F)) for c in ("practice", "team", "location", "designation")],
    _chart_sql("tools", _TOOLS_SQL),
])


@register("dashboard_bundle", W(f"SELECT * FROM ({_DASHBOARD_SQL})"))
def q_dashboard_bundle(spark, sf):
    """Every section of the filtered dashboard."""
    b = D.bundle(fx.usage(spark, sf), dashboard_q.FILTERED)
    charts = ["timeline", "practice", "team", "location", "designation", "tools"]
    return _together([_row("kpis", b["kpis"]), *[_chart(c, b[c]) for c in charts]])


_KPI_NAMES = ["total_workforce", "access_granted", "access_pending", "active_users", "inactive_users", "revoked_count",
              "resigned_count", "never_used_lifetime", "adoption_rate", "avg_actions_per_active"]
_ADOPTION_SQL = "\nUNION ALL ".join([
    _row_sql("kpis", _own("adoption_kpis"), _KPI_NAMES),
    *[_chart_sql(k, _own(k)) for k in ("team_access_coverage", "team_adoption_rate", "practice_access_coverage", "access_funnel")],
    *[_chart_sql(s, _own(k), "email", "1") for s, k in (("inactive_users", "inactive_members"), ("pending_access", "pending_members"), ("revoked_users", "revoked_members"))],
])


@register("adoption_bundle", f"SELECT * FROM ({_ADOPTION_SQL})")
def q_adoption_bundle(spark, sf):
    """Every section of the adoption report."""
    b = A.bundle(fx.roster(spark, sf), fx.usage(spark, sf))
    charts = ["team_access_coverage", "team_adoption_rate", "practice_access_coverage", "access_funnel"]
    people = ["inactive_users", "pending_access", "revoked_users"]
    return _together([_row("kpis", b["kpis"]), *[_chart(c, b[c]) for c in charts], *[_people(p, b[p]) for p in people]])


_SUMMARY_NAMES = ["total_members", "with_access", "members_active", "not_used", "total_activity", "top_user_actions", "adoption_rate",
                  "inactive_count", "access_pending", "avg_actions_per_active", "revoked_count", "resigned_count", "access_coverage_pct"]
_TEAM_SQL = "\nUNION ALL ".join([
    _row_sql("summary", _own("report_summary"), _SUMMARY_NAMES),
    _chart_sql("features", _own("feature_totals"), "label", "count"),
    _chart_sql("members_with_access", _own("report_members"), "user_email", "total_activity"),
    _chart_sql("members_without_access", _own("report_without_access"), "email", "1"),
])


@register("team_report_bundle", f"SELECT * FROM ({_TEAM_SQL})")
def q_team_report_bundle(spark, sf):
    """Every section of the team report."""
    b = T.build(spark, fx.roster(spark, sf), fx.usage(spark, sf), report_q.PRACTICE, report_q.TEAM, report_q.START, report_q.END)
    return _together([
        _row("summary", b["summary"]), _chart("features", b["features"], "label", "count"),
        _chart("members_with_access", b["members_with_access"], "user_email", "total_activity"),
        _people("members_without_access", b["members_without_access"]),
    ])

