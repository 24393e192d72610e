"""Public report API: one function per report of the reference, same parameters.

Each function returns DataFrames (or a dict of section DataFrames); nothing is collected.
Unfiltered calls are answered from the current snapshot when ``snapshot_root`` is given
and the section exists; everything else runs the live plan. ``usage`` may be the raw usage
table or its rollup for every report except the detail page and the detail export.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from adoptlens.operators.filters import Filters
from adoptlens.plans import adoption, dashboard, export, snapshots, sync, team_report


#: Order of the rows in the team report's document.
REPORT_ORDER = {"features": ["sort_order"], "members_with_access": ["name", "user_email"], "members_without_access": ["name", "email"]}


def _filters(practices=None, locations=None, accesses=None, designations=None, teams=None, products=None,
             start_date=None, end_date=None, search=None) -> Filters:
    return Filters(practices=practices, locations=locations, accesses=accesses, designations=designations,
                   teams=teams, products=products, start_date=start_date, end_date=end_date, search=search)


def _sectioned(spark, snapshot_root, names: dict[str, str], filters, live: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """``live`` sections, or those of the snapshot under their ``names`` there; nothing is computed for the latter."""
    if not snapshot_root:
        return live()
    found = snapshots.read_sections(spark, snapshot_root, list(names.values()), filters, lambda: {names[k]: v for k, v in live().items()})
    return {k: found[n] for k, n in names.items()}


def get_dashboard_bundle(spark: SparkSession, usage: DataFrame, practices: Sequence[str] | None = None,
                         locations=None, accesses=None, designations=None, teams=None, products=None,
                         start_date: dt.date | str | None = None, end_date=None,
                         snapshot_root: str | None = None) -> dict[str, DataFrame]:
    f = _filters(practices, locations, accesses, designations, teams, products, start_date, end_date)
    names = {k: f"dashboard.{k}" for k in dashboard.SECTIONS}
    return _sectioned(spark, snapshot_root, names, f, lambda: dashboard.bundle(usage, f))


def get_top_users(spark: SparkSession, usage: DataFrame, practices=None, locations=None, accesses=None,
                  designations=None, teams=None, products=None, start_date=None, end_date=None,
                  snapshot_root: str | None = None) -> DataFrame:
    f = _filters(practices, locations, accesses, designations, teams, products, start_date, end_date)
    return _sectioned(spark, snapshot_root, {"users": "top_users"}, f, lambda: {"users": dashboard.top_users(f.apply(usage))})["users"]


def get_usage_page(usage: DataFrame, practices=None, locations=None, accesses=None, designations=None,
                   teams=None, products=None, search: str = "", sort_key: str = "utc_time",
                   sort_asc: bool = False, page: int = 1, page_size: int = 20, start_date=None,
                   end_date=None, after: tuple | None = None) -> dict[str, DataFrame]:
    """{'total': one-row count, 'rows': the page}. ``after`` = (sort value, usage_id) of the
    previous page's last row selects the next page by cursor instead of by page number."""
    f = _filters(practices, locations, accesses, designations, teams, products, start_date, end_date, search)
    rows = (dashboard.usage_page_after(usage, f, sort_key, sort_asc, after, page_size) if after is not None
            else dashboard.usage_page(usage, f, sort_key, sort_asc, page, page_size))
    return {"total": dashboard.usage_total(usage, f), "rows": rows}


def export_usage_csv(usage: DataFrame, practices=None, locations=None, accesses=None, designations=None,
                     teams=None, products=None, search: str = "", start_date=None, end_date=None) -> DataFrame:
    f = _filters(practices, locations, accesses, designations, teams, products, start_date, end_date, search)
    return export.usage_lines(usage, f)


def write_usage_csv(usage: DataFrame, path: str, **filters) -> None:
    """Every detail line as ordered text part files; ``filters`` as for ``export_usage_csv``."""
    export.write_lines(export.usage_lines(usage, _filters(**filters), ordered=True), path, ["sort_key", "utc_time", "usage_id"])


def write_top_users_csv(usage: DataFrame, path: str, **filters) -> None:
    """Every leaderboard line as ordered text part files; ``filters`` as for ``export_top_users_csv``."""
    export.write_lines(export.top_user_lines(usage, _filters(**filters)), path, ["rank_val"])


def export_top_users_csv(usage: DataFrame, practices=None, locations=None, accesses=None, designations=None,
                         teams=None, products=None, start_date=None, end_date=None) -> DataFrame:
    f = _filters(practices, locations, accesses, designations, teams, products, start_date, end_date)
    return export.top_user_lines(usage, f)


def get_filter_options(spark: SparkSession, usage: DataFrame, snapshot_root: str | None = None) -> dict[str, DataFrame]:
    names = {"values": "filter_options", "products": "filter_options.products",
             "teams_by_practice": "filter_options.teams_by_practice"}
    return _sectioned(spark, snapshot_root, names, None, lambda: {
        "values": dashboard.filter_options(usage), "products": dashboard.product_options(usage), "teams_by_practice": dashboard.teams_by_practice(usage)})


def get_adoption_bundle(spark: SparkSession, roster: DataFrame, usage: DataFrame, practices=None, teams=None,
                        locations=None, designations=None, start_date=None, end_date=None,
                        snapshot_root: str | None = None) -> dict[str, DataFrame]:
    f = Filters(practices=practices, teams=teams, locations=locations, designations=designations,
                start_date=start_date, end_date=end_date)
    names = {k: f"adoption.{k}" for k in adoption.SECTIONS}
    return _sectioned(spark, snapshot_root, names, f, lambda: adoption.bundle(roster, usage, f))


def get_adoption_filter_options(roster: DataFrame) -> DataFrame:
    return adoption.adoption_filter_options(roster)


def get_team_report_bundle(spark: SparkSession, roster: DataFrame, usage: DataFrame, practice: str,
                           team: str | None = None, start_date=None, end_date=None) -> dict[str, DataFrame]:
    return team_report.build(spark, roster, usage, practice, team, start_date, end_date)


def get_team_report_document(spark: SparkSession, roster: DataFrame, usage: DataFrame, practice: str,
                             team: str | None = None, start_date=None, end_date=None, path: str | None = None) -> DataFrame:
    """The team report as one JSON document of any length: (section, number, line) in order.

    With ``path`` it is written there as text files as well (``export.write_document``).
    """
    sections = team_report.build(spark, roster, usage, practice, team, start_date, end_date)
    if path is not None:
        export.write_document(sections, path, REPORT_ORDER)
    return export.document_lines(sections, REPORT_ORDER)


def get_sync_info(spark: SparkSession, meta_path: str) -> DataFrame:
    return spark.read.parquet(meta_path)


def refresh_dashboard_cache(spark: SparkSession, usage: DataFrame, roster: DataFrame, snapshot_root: str) -> str:
    return snapshots.refresh(spark, usage, roster, snapshot_root)


def sync_metadata(usage: DataFrame, last_sync_rows: int | None = None) -> DataFrame:
    return sync.sync_metadata(usage, last_sync_rows)
