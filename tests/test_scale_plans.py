"""Scale properties asserted on physical plans, with a hot key holding a third of the rows."""

from pyspark.sql import functions as F

from adoptlens.operators.dedupe import keep_last
from adoptlens.operators.filters import Filters
from adoptlens.plans import dashboard as D
from adoptlens.plans import team_report as T
from adoptlens.plans.rollup import usage_rollup
from adoptlens.sources import fixtures as fx

from paths import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _skewed_usage(spark):
    """Usage where one user owns every third event (a third of all rows)."""
    u = fx.usage(spark, SF001)
    hot = F.col("usage_id").cast("long") % 3 == 0
    return u.withColumn("user_email", F.when(hot, F.lit("hot@example.com")).otherwise(F.col("user_email")))


def test_leaderboard_is_hash_aggregated_map_side_under_skew(spark):
    u = _skewed_usage(spark)
    top = D.top_users(u)
    plan = _plan(top)
    assert "HashAggregate" in plan and "partial_count" in plan
    rows = top.collect()
    assert rows[0].user == "hot@example.com"
    assert rows[0].actions == u.filter(F.col("user_email") == "hot@example.com").count()
    assert sum(r.actions for r in rows) == u.count()


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey")))
    out = keep_last(hot, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == hot.select("l_orderkey", "l_linenumber").distinct().count()


def test_filters_reach_the_parquet_scan(spark):
    f = Filters(accesses=["click"], start_date="2024-01-10", end_date="2024-01-12")
    plan = _formatted(D.kpis(f.apply(fx.usage(spark, SF001))))
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters") and "(ts" in line]
    assert pushed, plan
    assert "GreaterThanOrEqual(ts,2024-01-09T18:30)" in pushed[0] and "LessThan(ts,2024-01-12T18:30)" in pushed[0]
    assert "EqualTo(event_type,click)" in pushed[0]  # a one-value IN is rewritten to =
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema") and "event_id" in line]
    assert read and "props" not in read[0] and "value" not in read[0]  # pruned columns


def test_team_report_needs_no_explode_join(spark):
    u = T.usage_scope(fx.usage(spark, SF001), "HOUSEHOLD", None, "2024-01-01", "2024-01-31")
    plan = _plan(T.user_features(u))
    assert "Generate" not in plan  # feature counts come from higher-order functions, no explode


def test_rollup_reports_equal_raw_under_skew(spark):
    u = _skewed_usage(spark)
    r = usage_rollup(u)
    assert sorted(map(tuple, D.top_users(r).collect())) == sorted(map(tuple, D.top_users(u).collect()))
    assert D.kpis(r).collect() == D.kpis(u).collect()
    assert sorted(map(tuple, D.top_tools_with_other(r).collect())) == \
        sorted(map(tuple, D.top_tools_with_other(u).collect()))


def test_roster_join_is_left_to_the_planner(spark):
    from adoptlens.operators.enrich import enrich_usage, normalize_events

    events = normalize_events(fx.raw_events(spark, SF001))
    plan = _plan(enrich_usage(events, fx.roster(spark, SF001)))
    assert "BroadcastHashJoin" in plan  # a small roster, by the planner's own threshold
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in _plan(enrich_usage(events, fx.roster(spark, SF001)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rollup_equals_raw_for_random_filters(spark):
    import random

    from adoptlens.plans import adoption as A

    u = fx.usage(spark, SF001).persist()
    r = usage_rollup(u).persist()
    rnd = random.Random(11)
    dims = {"practices": ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", ""], "accesses": ["click", "view", "error"],
            "designations": ["Associate", "Partner", "Trainee"], "products": ["Vault", "Assistant", "Thread"]}
    roster = fx.roster(spark, SF001)
    for _ in range(5):
        kw = {k: rnd.sample(v, rnd.randint(1, 2)) for k, v in dims.items() if rnd.random() < 0.5}
        day = rnd.randint(1, 20)
        f = Filters(start_date=f"2024-01-{day:02d}", end_date=f"2024-01-{day + rnd.randint(0, 9):02d}",
                    search=rnd.choice([None, "nation_1", "user1"]), **kw)
        fr, fu = f.apply(r), f.apply(u)
        assert D.kpis(fr).collect() == D.kpis(fu).collect(), f
        assert sorted(map(tuple, D.top_users(fr).collect())) == sorted(map(tuple, D.top_users(fu).collect())), f
        assert sorted(map(tuple, D.tool_counts(fr).collect())) == sorted(map(tuple, D.tool_counts(fu).collect())), f
        assert sorted(map(tuple, D.timeline(fr).collect())) == sorted(map(tuple, D.timeline(fu).collect())), f
    assert A.adoption_kpis(A.roster_activity(roster, r)).collect() == A.adoption_kpis(A.roster_activity(roster, u)).collect()
    u.unpersist()
    r.unpersist()


def test_bundles_scan_raw_events_once(spark):
    from adoptlens.plans import adoption as A

    u, r = fx.usage(spark, SF001), fx.roster(spark, SF001)
    bundles = [D.bundle(u, Filters(accesses=["click"])), A.bundle(r, u),
               T.build(spark, r, u, "HOUSEHOLD", None, "2024-01-01", "2024-01-31")]
    for bundle in bundles:  # the sections read what the one scan left
        for name, section in bundle.items():
            files = section.inputFiles()
            assert not any("events.parquet" in f for f in files), name
