"""The same reports answered from the usage rollup; each key reuses the raw key's oracle,
so a match proves the rollup path exact."""

from __future__ import annotations

from adoptlens.catalog import ORACLES, register
from adoptlens.catalog import adoption_q, dashboard_q, ingest_q, report_q  # noqa: F401  (oracles first)
from adoptlens.catalog.dashboard_q import FILTERED
from adoptlens.catalog.report_q import END, PRACTICE, START, TEAM
from adoptlens.plans import adoption as A
from adoptlens.plans import dashboard as D
from adoptlens.plans import sync as S
from adoptlens.plans import team_report as T
from adoptlens.plans.rollup import usage_rollup
from adoptlens.operators.enrich import match_audit
from adoptlens.sources import fixtures as fx

W = fx.with_fixtures


def _r(spark, sf):
    return usage_rollup(fx.usage(spark, sf))


@register("usage_rollup", W("""
SELECT usage_date, user_email, email, workforce_name, practice, team, location, designation, access_point,
       product_area, COUNT(*) AS _n, CAST(SUM(file_count) AS BIGINT) AS _files
FROM usage GROUP BY ALL"""))
def q_usage_rollup(spark, sf):
    return _r(spark, sf)


def _same(raw_key: str, name: str, fn):
    register(name, ORACLES[raw_key])(fn)


_same("dashboard_kpis", "rollup_dashboard_kpis", lambda s, sf: D.kpis(_r(s, sf)))
_same("dashboard_kpis_filtered", "rollup_dashboard_kpis_filtered", lambda s, sf: D.kpis(FILTERED.apply(_r(s, sf))))
_same("dimension_counts", "rollup_dimension_counts", lambda s, sf: D.dimension_counts(_r(s, sf)))
_same("top_tools_with_other", "rollup_top_tools_with_other", lambda s, sf: D.top_tools_with_other(_r(s, sf)))
_same("top_users", "rollup_top_users", lambda s, sf: D.top_users(_r(s, sf)))
_same("top_users_filtered", "rollup_top_users_filtered", lambda s, sf: D.top_users(FILTERED.apply(_r(s, sf))))
_same("filter_options", "rollup_filter_options", lambda s, sf: D.filter_options(_r(s, sf)))
_same("adoption_kpis", "rollup_adoption_kpis",
      lambda s, sf: A.adoption_kpis(A.roster_activity(fx.roster(s, sf), _r(s, sf))))
_same("adoption_kpis_filtered", "rollup_adoption_kpis_filtered",
      lambda s, sf: A.adoption_kpis(A.roster_activity(fx.roster(s, sf), _r(s, sf), adoption_q.ADOPT_FILTERED)))


def _scope(s, sf):
    return (T.roster_scope(fx.roster(s, sf), PRACTICE, TEAM), T.usage_scope(_r(s, sf), PRACTICE, TEAM, START, END))


_same("user_feature_pivot", "rollup_user_feature_pivot", lambda s, sf: T.user_features(_scope(s, sf)[1]))
_same("feature_totals", "rollup_feature_totals", lambda s, sf: T.feature_totals(_scope(s, sf)[1]))
_same("report_summary", "rollup_report_summary",
      lambda s, sf: (lambda hr, u: T.report_summary(hr, T.user_features(u), u))(*_scope(s, sf)))
_same("sync_metadata", "rollup_sync_metadata", lambda s, sf: S.sync_metadata(_r(s, sf)))
_same("match_audit", "rollup_match_audit", lambda s, sf: match_audit(_r(s, sf)))
