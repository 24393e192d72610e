"""Report invariants on the sf0.001 fixture, snapshot reads and the driver contract."""

import pytest
from pyspark.sql import functions as F

from adoptlens.operators.filters import Filters
from adoptlens.plans import adoption as A
from adoptlens.plans import dashboard as D
from adoptlens.plans import snapshots as SN
from adoptlens.sources import fixtures as fx

from paths import SF001


def test_top8_plus_other_equals_all_tools(spark):
    u = fx.usage(spark, SF001)
    total = D.tool_counts(u).agg(F.sum("value")).collect()[0][0]
    top = D.top_tools_with_other(u).collect()
    assert sum(r.value for r in top) == total
    assert top[-1].is_other and top[-1].label == "Other"


def test_timeline_sums_to_dated_rows(spark):
    u = fx.usage(spark, SF001)
    assert D.timeline(u).agg(F.sum("value")).collect()[0][0] == u.filter(F.col("usage_date").isNotNull()).count()


def test_funnel_sums_to_roster(spark):
    e = A.roster_activity(fx.roster(spark, SF001), fx.usage(spark, SF001))
    assert A.access_funnel(e).agg(F.sum("value")).collect()[0][0] == e.count()


def test_page_and_total_consistent(spark):
    u = fx.usage(spark, SF001)
    f = Filters(search="nation_1")
    total = D.usage_total(u, f).collect()[0][0]
    pages = sum(D.usage_page(u, f, page=p, page_size=50).count() for p in range(1, total // 50 + 2))
    assert pages == total


def test_snapshot_read_or_compute(spark, scratch):
    u, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    live = D.kpis(u).collect()
    calls = []

    def compute():
        calls.append(1)
        return D.kpis(u)

    assert SN.read_or_compute(spark, scratch, "dashboard.kpis", Filters(), compute).collect() == live
    assert calls == [1]  # no snapshot yet
    SN.refresh(spark, u, r, scratch, {"dashboard.kpis": D.kpis(u), "top_users": D.top_users(u)})
    assert SN.read_or_compute(spark, scratch, "dashboard.kpis", Filters(), compute).collect() == live
    assert calls == [1]  # answered from the snapshot
    SN.read_or_compute(spark, scratch, "dashboard.kpis", Filters(practices=["X"]), compute)
    SN.read_or_compute(spark, scratch, "dashboard.missing", Filters(), compute)
    assert calls == [1, 1, 1]


def test_document_keeps_nulls(spark):
    df = spark.createDataFrame([("b", 2, None), ("a", 1, "x")], "label string, value int, note string")
    doc = SN.to_document({"rows": df}, {"rows": ["value"]}).collect()[0][0]
    assert doc == '{"rows":[{"label":"a","value":1,"note":"x"},{"label":"b","value":2,"note":null}]}'


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 1
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


def test_full_refresh_sections_equal_live(spark, scratch):
    u, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    SN.refresh(spark, u, r, scratch)
    for name, live in [("dashboard.kpis", D.kpis(u)), ("dashboard.location", D.count_by(u, "location")),
                       ("top_users", D.top_users(u)), ("dashboard.tools", D.top_tools_with_other(u)),
                       ("adoption.kpis", A.adoption_kpis(A.roster_activity(r, u)))]:
        snap = SN.read_section(spark, scratch, name)
        assert sorted(map(tuple, snap.collect())) == sorted(map(tuple, live.collect())), name


def test_public_api_matches_plans_and_uses_snapshot(spark, scratch):
    from adoptlens import api

    u, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    b = api.get_dashboard_bundle(spark, u, practices=["AUTOMOBILE"], start_date="2024-01-05")
    assert set(b) >= {"kpis", "timeline", "practice", "team", "location", "tools", "designation"}
    page = api.get_usage_page(u, search="nation_1", page=2, page_size=10)
    assert page["rows"].count() == 10 and page["total"].collect()[0][0] > 10
    lines = [r.line for r in api.export_top_users_csv(u).orderBy("rank_val").collect()]
    assert lines[0] == "Rank,User Email,Workforce Name,Designation,Location,Actions,Files" and lines[1].startswith("1,")
    assert len(lines) == D.top_users(u).count() + 1
    api.refresh_dashboard_cache(spark, u, r, scratch)
    snap = api.get_top_users(spark, u, snapshot_root=scratch)
    assert sorted(map(tuple, snap.collect())) == sorted(map(tuple, D.top_users(u).collect()))
    rep = api.get_team_report_bundle(spark, r, u, "HOUSEHOLD", None, "2024-01-01", "2024-01-31")
    assert rep["summary"].count() == 1 and rep["features"].count() == 6
    ad = api.get_adoption_bundle(spark, r, u, snapshot_root=scratch)
    assert ad["kpis"].collect() == A.adoption_kpis(A.roster_activity(r, u)).collect()


def test_tool_named_other_is_not_merged(spark):
    rows = [("u1", "Other")] * 3 + [(f"u{i}", f"T{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "user_email string, product_area string")
    top = D.top_tools_with_other(df).collect()
    labels = [(r.label, r.is_other) for r in top]
    assert ("Other", False) in labels and ("Other", True) in labels
    assert top[-1].is_other and sum(r.value for r in top) == 15


def test_stream_result_equals_batch_result(spark):
    from adoptlens.catalog import QUERIES, load_all

    load_all()
    streamed = QUERIES["stream_ingest"](spark, SF001)
    batch = fx.usage(spark, SF001).select(*streamed.columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_empty_inputs_give_zero_counts(spark):
    from adoptlens.plans import sync as S
    from adoptlens.plans import team_report as T
    from adoptlens.plans.rollup import usage_rollup

    u = fx.usage(spark, SF001).filter(F.lit(False))
    for frame in (u, usage_rollup(u)):
        m = S.sync_metadata(frame).collect()[0]
        assert m.row_count == 0 and m.last_sync_rows == 0 and m.max_date is None
        k = D.kpis(frame).collect()[0]
        assert (k.active_users, k.total_actions, k.practice_areas) == (0, 0, 0)
        assert D.timeline(frame).count() == 0 and D.top_tools_with_other(frame).count() == 0
    s = T.report_summary(fx.roster(spark, SF001).filter(F.lit(False)), T.user_features(u), u).collect()[0]
    assert s.top_user_name == "—" and s.top_user_actions == 0 and s.adoption_rate == 0.0


def test_remaining_api_functions(spark, scratch):
    from adoptlens import api
    from adoptlens.session import scale_settings
    from adoptlens.streaming.ingest import refresh_metadata

    u, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    lines = api.export_usage_csv(u, accesses=["click"])
    assert lines.filter("sort_key = 0").count() == 1
    assert lines.count() == 1 + u.filter(F.col("access_point") == "click").count()
    opts = api.get_filter_options(spark, u)
    assert set(opts) == {"values", "products", "teams_by_practice"} and opts["products"].count() > 0
    assert api.get_adoption_filter_options(r).filter("dimension = 'teams'").count() > 0
    u.write.parquet(f"{scratch}/usage")
    refresh_metadata(spark, f"{scratch}/usage", f"{scratch}/meta", last_sync_rows=7)
    info = api.get_sync_info(spark, f"{scratch}/meta").collect()[0]
    assert info.row_count == u.count() and info.last_sync_rows == 7
    conf = scale_settings(100 * 1024 ** 4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 819_200
    assert int(scale_settings(10 * 1024 ** 3)["spark.sql.shuffle.partitions"]) == 200


def test_numbered_equals_sorted_positions(spark):
    from adoptlens.operators.ranking import numbered

    u = fx.usage(spark, SF001).select("usage_id", "user_email")
    got = numbered(u, [F.asc("user_email"), F.asc("usage_id")], "n").orderBy("n").collect()
    want = u.orderBy("user_email", "usage_id").collect()
    assert [(r.usage_id, r.n) for r in got] == [(r.usage_id, i + 1) for i, r in enumerate(want)]


def test_write_lines_keeps_every_line_in_order(spark, scratch):
    from adoptlens.plans import export as X

    u = fx.usage(spark, SF001)
    X.write_lines(X.usage_lines(u, ordered=True), f"{scratch}/out", ["sort_key", "utc_time", "usage_id"])
    lines = [r.value for r in spark.read.text(f"{scratch}/out").collect()]
    assert lines[0] == X.USAGE_HEADER and len(lines) == u.count() + 1
    assert lines[1:] == sorted(lines[1:], key=lambda x: x[:19])


def test_incremental_refresh_equals_full_refresh(spark, scratch):
    import datetime as dt

    u1, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    SN.refresh(spark, u1, r, f"{scratch}/inc")
    d5, d6 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
    # a later sync removed day 5's events and re-labelled day 6's access points
    u2 = (u1.filter(F.col("usage_date") != d5)
          .withColumn("access_point", F.when(F.col("usage_date") == d6, F.lit("resynced")).otherwise(F.col("access_point"))))
    SN.refresh_incremental(spark, u2, r, f"{scratch}/inc", [d5, d6])
    SN.refresh(spark, u2, r, f"{scratch}/full")
    for name in ["usage_rollup", "dashboard.kpis", "dashboard.timeline", "dashboard.location", "top_users",
                 "filter_options", "adoption.kpis", "dashboard.tools"]:
        inc = SN.read_section(spark, f"{scratch}/inc", name)
        full = SN.read_section(spark, f"{scratch}/full", name)
        assert sorted(map(tuple, inc.collect()), key=str) == sorted(map(tuple, full.collect()), key=str), name


def test_incremental_refresh_keeps_and_renews_events_without_a_day(spark, scratch):
    import datetime as dt

    d5 = dt.date(2024, 1, 5)
    r = fx.roster(spark, SF001)
    lost = F.when(F.col("usage_id").cast("int") % 10 == 0, F.lit(None)).otherwise(F.col("usage_date"))
    u1 = fx.usage(spark, SF001).withColumn("usage_date", lost)
    SN.refresh(spark, u1, r, f"{scratch}/a")
    u2 = u1.filter(~F.col("usage_date").eqNullSafe(F.lit(d5)))
    SN.refresh_incremental(spark, u2, r, f"{scratch}/a", [d5])
    u3 = u2.withColumn("access_point", F.when(F.col("usage_date").isNull(), F.lit("new")).otherwise(F.col("access_point")))
    for u, touched in ((u2, [d5]), (u3, [None])):
        SN.refresh_incremental(spark, u, r, f"{scratch}/a", touched)
        SN.refresh(spark, u, r, f"{scratch}/full")
        for name in ["usage_rollup", "dashboard.kpis", "top_users"]:
            inc, full = (SN.read_section(spark, f"{scratch}/{x}", name) for x in ("a", "full"))
            assert sorted(map(tuple, inc.collect()), key=str) == sorted(map(tuple, full.collect()), key=str), name


def test_cursor_pages_walk_equals_offset_pages(spark):
    from adoptlens.plans import dashboard as Dm

    u = fx.usage(spark, SF001)
    for key, asc in (("utc_time", False), ("Location", True), ("Location", False)):
        col = Dm.SORT_KEYS.get(key, "utc_time")
        expected = [r.usage_id for r in Dm.usage_page(u, sort_key=key, ascending=asc, page=1, page_size=10_000).collect()]
        got, cursor = [], None
        while True:
            page = Dm.usage_page_after(u, sort_key=key, ascending=asc, after=cursor, page_size=97).collect()
            if not page:
                break
            got += [r.usage_id for r in page]
            cursor = (page[-1][col], page[-1].usage_id)
        assert got == expected, key


def test_team_report_document_holds_every_section(spark, scratch):
    import json
    import pathlib

    from adoptlens import api
    from adoptlens.plans import team_report as T

    lines = api.get_team_report_document(spark, fx.roster(spark, SF001), fx.usage(spark, SF001), "HOUSEHOLD", None,
                                         "2024-01-01", "2024-01-31", path=f"{scratch}/document")
    doc = json.loads("".join(r.line for r in lines.orderBy("section", "number").collect()))
    files = sorted(str(p) for p in pathlib.Path(scratch.replace("file:", ""), "document").glob("section=*/part-*"))
    assert json.loads("".join(open(f).read() for f in files)).keys() == doc.keys()
    assert set(doc) == {"meta", "summary", "features", "members_with_access", "members_without_access"}
    assert doc["meta"][0]["disclaimer"] == T.DISCLAIMER and len(doc["features"]) == 6
    assert doc["summary"][0]["with_access"] == len(doc["members_with_access"])


def test_a_snapshot_read_scans_no_events_and_leaves_no_files(spark, scratch):
    import os

    from adoptlens import api
    from adoptlens.session import checkpoint_dir, remove_path

    fx.usage(spark, SF001).write.parquet(f"{scratch}/events")
    usage, r = spark.read.parquet(f"{scratch}/events"), fx.roster(spark, SF001)
    api.refresh_dashboard_cache(spark, usage, r, f"{scratch}/snap")
    want = {k: sorted(map(tuple, v.collect())) for k, v in D.bundle(usage).items()}
    people = {k: sorted(map(tuple, v.collect()), key=str) for k, v in A.bundle(r, usage).items()}
    remove_path(spark, f"{scratch}/events")  # whoever reads an event from here on fails
    held = sorted(os.listdir(checkpoint_dir(spark).replace("file:", "")))
    got = api.get_dashboard_bundle(spark, usage, snapshot_root=f"{scratch}/snap")
    assert {k: sorted(map(tuple, v.collect())) for k, v in got.items()} == want
    got = api.get_adoption_bundle(spark, r, usage, snapshot_root=f"{scratch}/snap")
    assert {k: sorted(map(tuple, v.collect()), key=str) for k, v in got.items()} == people
    assert api.get_top_users(spark, usage, snapshot_root=f"{scratch}/snap").count() > 0
    assert all(v.count() for v in api.get_filter_options(spark, usage, snapshot_root=f"{scratch}/snap").values())
    assert sorted(os.listdir(checkpoint_dir(spark).replace("file:", ""))) == held
    with pytest.raises(Exception):  # noqa: B017
        api.get_dashboard_bundle(spark, usage, practices=["BUILDING"], snapshot_root=f"{scratch}/snap")


def test_incremental_refresh_keeps_what_did_not_change(spark, scratch):
    import datetime as dt

    from adoptlens.operators import versions

    d6 = dt.date(2024, 1, 6)
    usage, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    first = SN._manifest(spark, scratch, SN.refresh(spark, usage, r, scratch))
    days = versions.current(spark, f"{scratch}/rollup").folders
    tools = usage.withColumn("product_area", F.when(F.col("usage_date") == d6, F.lit("Vault,New")).otherwise(F.col("product_area")))
    second = SN._manifest(spark, scratch, SN.refresh_incremental(spark, tools, r, scratch, [d6]))
    assert {n for n in second["sections"] if second["sections"][n] != first["sections"][n]} == {"dashboard.tools", "filter_options.products"}
    assert {n for n in second["states"] if second["states"][n] != first["states"][n]} == {"tools"}
    now = versions.current(spark, f"{scratch}/rollup").folders
    assert {d for d in days if now[d] != days[d]} == {"2024-01-06"}
    third = SN._manifest(spark, scratch, SN.refresh_incremental(spark, tools, r.limit(30), scratch, [d6]))
    assert {n for n in third["sections"] if third["sections"][n] != second["sections"][n]} == {f"adoption.{s}" for s in A.SECTIONS}
    full = f"{scratch}/full"
    SN.refresh(spark, tools, r.limit(30), full)
    for name in first["sections"]:
        inc, want = (sorted(map(tuple, SN.read_section(spark, x, name).collect()), key=str) for x in (scratch, full))
        assert inc == want, name


def test_scratch_tables_go_with_their_scope(spark):
    from adoptlens.session import path_exists, scratch_path, scratch_scope

    kept = scratch_path(spark, "kept")
    spark.range(1).write.parquet(kept)
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        spark.range(1).write.parquet(inner)
    assert path_exists(spark, kept) and not path_exists(spark, inner)


def test_a_refresh_that_dies_is_made_good_by_the_next(spark, scratch, monkeypatch):
    import datetime as dt

    d6, d8 = dt.date(2024, 1, 6), dt.date(2024, 1, 8)
    usage, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    SN.refresh(spark, usage, r, scratch)

    def without(*days):
        return usage.filter(~F.col("usage_date").isin(*days))

    real = SN._finish
    monkeypatch.setattr(SN, "_finish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        SN.refresh_incremental(spark, without(d6), r, scratch, [d6])
    monkeypatch.setattr(SN, "_finish", real)
    assert SN.read_section(spark, scratch, "dashboard.kpis").collect() == D.kpis(usage).collect()
    SN.refresh_incremental(spark, without(d8), r, scratch, [d8])  # the lost day is not touched again
    assert SN.read_section(spark, scratch, "dashboard.kpis").collect() == D.kpis(without(d8)).collect()
    assert SN.read_section(spark, scratch, "usage_rollup").agg(F.sum("_n")).first()[0] == without(d8).count()
    SN.refresh_incremental(spark, without(d6, d8), r, scratch, [d6])
    assert SN.read_section(spark, scratch, "dashboard.kpis").collect() == D.kpis(without(d6, d8)).collect()


def test_csv_lines_are_put_together_once_where_they_are_read(spark, scratch):
    from adoptlens.sources import csv_split

    spark.createDataFrame([('a,b\n1,"x\n""y"""\n2,z',)], "text string").coalesce(1).write.text(scratch)
    found = csv_split.records(spark, scratch)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Scan text" not in plan  # both kinds of records come from one stored table
    assert sorted(r.text for r in found.collect()) == ['1,"x\n""y"""', "2,z", "a,b"]


def test_the_task_that_writes_one_file_joins_nothing(spark, monkeypatch):
    from adoptlens.catalog import reports_q

    plans, real = [], reports_q.write_extract_csv
    monkeypatch.setattr(reports_q, "write_extract_csv", lambda df, path: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, path))
    assert reports_q.q_bulk_import_one_file(spark, SF001).count() > 0
    assert len(plans) == 1 and "Join" not in plans[0]
