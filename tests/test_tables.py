"""Versioned tables, their locator, live counts, late rows, bitmaps, ranked pages, search dictionary."""

import datetime as dt
import re

import pytest
from paths import SF001
from pyspark.sql import functions as F

from adoptlens.operators import locator, versions
from adoptlens.operators import upsert as U
from adoptlens.operators.filters import Filters
from adoptlens.plans import adoption as A
from adoptlens.plans import bitmaps, pages, search
from adoptlens.plans import dashboard as D
from adoptlens.sources import fixtures as fx
from adoptlens.streaming import live

SCHEMA = "id string, v int, day date"
D1, D2, D3 = (dt.date(2024, 1, k) for k in (1, 2, 3))


def up(spark, path, rows, **options):
    return U.upsert_into_table(spark, path, spark.createDataFrame(rows, SCHEMA), ["id"], ["v"], "day", **options)


def held(spark, path, number=None):
    return sorted(tuple(r) for r in versions.read_table(spark, path, number).select("id", "v", F.col("day").cast("string")).fillna("-").collect())


# --- versions --------------------------------------------------------------------------


def test_an_open_reader_keeps_its_version(spark, scratch):
    up(spark, scratch, [("a", 1, D1), ("b", 1, D2)])
    reader = versions.read_table(spark, scratch)
    up(spark, scratch, [("a", 2, D2), ("c", 2, D3)])  # the first day empties
    assert sorted(r.id for r in reader.collect()) == ["a", "b"]
    assert held(spark, scratch) == [("a", 2, "2024-01-02"), ("b", 1, "2024-01-02"), ("c", 2, "2024-01-03")]
    assert held(spark, scratch, 1) == [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]


def test_a_plain_reader_sees_no_mixture(spark, scratch):
    up(spark, scratch, [("a", 1, D1)])
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(scratch).count()


@pytest.mark.parametrize("step", ["write_partitions", "add", "publish"])
def test_a_writer_that_dies_changes_nothing(spark, scratch, monkeypatch, step):
    up(spark, scratch, [("a", 1, D1), ("b", 1, D1)])
    before = held(spark, scratch)
    module = locator if step == "add" else versions
    real = getattr(module, step)

    def dies(*args, **kwargs):
        if step != "publish":
            real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(module, step, dies)
    with pytest.raises(RuntimeError):
        up(spark, scratch, [("a", 2, D2), ("c", 2, D2)])
    assert held(spark, scratch) == before
    monkeypatch.setattr(module, step, real)
    up(spark, scratch, [("a", 2, D2), ("c", 2, D2)])
    assert held(spark, scratch) == [("a", 2, "2024-01-02"), ("b", 1, "2024-01-01"), ("c", 2, "2024-01-02")]


def test_the_second_of_two_writers_fails(spark, scratch):
    up(spark, scratch, [("a", 1, D1)])
    version = versions.current(spark, scratch)
    up(spark, scratch, [("b", 1, D1)])
    late = versions.Version(version.number + 1, version.schema, "day", version.folders)
    with pytest.raises(versions.ConcurrentChange):
        versions.publish(spark, scratch, late)
    assert [r[0] for r in held(spark, scratch)] == ["a", "b"]


def test_unused_folders_go(spark, scratch):
    for k in range(6):
        up(spark, scratch, [("a", k, D1)])
    kept = [n for n in versions._names(spark, f"{scratch}/_data") if versions._names(spark, f"{scratch}/_data/{n}")]
    partitions = [p for n in kept for p in versions._names(spark, f"{scratch}/_data/{n}") if "=" in p]
    assert len(partitions) == versions.KEEP + 1  # with the current one
    versions.write_partitions(spark.createDataFrame([("x", 1, D3)], SCHEMA), scratch, 99, "day")
    assert versions.vacuum(spark, scratch) == ["_data/_v=99/day=2024-01-03"]
    assert held(spark, scratch) == [("a", 5, "2024-01-01")]


def test_a_plain_table_becomes_a_versioned_one(spark, scratch):
    spark.createDataFrame([("a", 1, D1), ("b", 1, None)], SCHEMA).write.partitionBy("day").parquet(scratch)
    up(spark, scratch, [("a", 2, None)])
    assert held(spark, scratch) == [("a", 2, "-"), ("b", 1, "-")]
    assert all(n.startswith("_") for n in versions._names(spark, scratch))


def test_empty_text_is_the_null_partition(spark, scratch):
    def write(rows):
        U.upsert_into_table(spark, scratch, spark.createDataFrame(rows, "id string, m string"), ["id"], [], "m")

    write([("a", None), ("b", "x y/z")])
    write([("c", ""), ("b", "")])
    assert sorted(tuple(r) for r in versions.read_table(spark, scratch).collect()) == [("a", None), ("b", None), ("c", None)]


def test_the_ledger_stops_a_repeated_batch(spark, scratch):
    up(spark, scratch, [("a", 5, D1)], ledger=("s", 1))
    assert up(spark, scratch, [("a", 1, D2)], ledger=("s", 1)) == [] and up(spark, scratch, [("a", 1, D2)], ledger=("s", 0)) == []
    assert held(spark, scratch) == [("a", 5, "2024-01-01")]
    up(spark, scratch, [("a", 3, D1), ("b", 3, D1)], newer_by="v")
    assert held(spark, scratch) == [("a", 5, "2024-01-01"), ("b", 3, "2024-01-01")]


# --- locator ---------------------------------------------------------------------------


def test_a_batch_reads_no_untouched_partition(spark, scratch, monkeypatch):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(20)]
    up(spark, scratch, [(f"k{i}", i, days[i % 20]) for i in range(400)])
    read, buckets = [], []
    real, real_rows = versions.read_folders, locator._read
    monkeypatch.setattr(versions, "read_folders", lambda s, p, v, values=None: read.append(values) or real(s, p, v, values))
    monkeypatch.setattr(locator, "_read", lambda s, p, r, b=None: buckets.append(b) or real_rows(s, p, r, b))
    up(spark, scratch, [(f"new{i}", i, D3) for i in range(50)])
    assert read == [{"2024-01-03"}]  # one day, and no key columns of any other
    read.clear()
    up(spark, scratch, [("k7", 1, D3), ("x", 1, D3)])  # k7 lies on the eighth
    assert read == [{"2024-01-08"}, {"2024-01-03", "2024-01-08"}]
    assert len(held(spark, scratch)) == 451


def test_locator_finds_every_key_and_reads_few_buckets(spark, scratch, monkeypatch):
    monkeypatch.setattr(locator, "BUCKET_KEYS", 50)
    runs = []
    for k in range(7):
        entries = spark.range(k * 300, k * 300 + (300 if k % 3 else 900)).select(F.xxhash64("id").alias("hash"), F.lit(f"p{k}").alias("part"))
        runs, _ = locator.add(spark, scratch, k, entries, runs)
    assert len(runs) < 7 and all(a["n"] > 2 * b["n"] for a, b in zip(runs, runs[1:]))
    asked = spark.range(0, 2400, 7).select(F.xxhash64("id").alias("hash"))
    want = {(r.hash, f"p{k}") for k in range(7) for r in spark.range(k * 300, k * 300 + (300 if k % 3 else 900)).select(F.xxhash64("id").alias("hash")).join(asked, "hash").collect()}
    assert {tuple(r) for r in locator.find(spark, scratch, asked, runs).collect()} == want
    seen = []
    real = locator._read
    monkeypatch.setattr(locator, "_read", lambda s, p, r, b=None: seen.append(b) or real(s, p, r, b))
    locator.find(spark, scratch, spark.range(10**6, 10**6 + 40).select(F.xxhash64("id").alias("hash")), runs)
    assert sum(map(len, seen)) <= 2  # none of these keys is known


def test_keys_of_a_long_batch_are_not_broadcast(spark, scratch, monkeypatch):
    monkeypatch.setattr(locator, "SHORT", 100)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"), F.lit(D1).alias("day"))
    U.upsert_into_table(spark, scratch, rows, ["id"], ["v"], "day")
    asked = rows.select(locator.key_hash(["id"]).alias("hash"))
    run = versions.current(spark, scratch).runs[0]
    plans = [locator._maybe(spark, scratch, run, asked), locator.find(spark, scratch, asked, [run])]
    assert all("Broadcast" not in p._jdf.queryExecution().executedPlan().toString() for p in plans)
    assert plans[1].count() == 4000
    U.upsert_into_table(spark, scratch, rows.withColumns({"v": F.lit(2), "day": F.lit(D2)}), ["id"], ["v"], "day")
    assert {tuple(r)[1:] for r in versions.read_table(spark, scratch).collect()} == {(2, D2)}


def test_a_run_with_a_filter_of_before_is_read_whole(spark, scratch):
    entries = spark.range(300).select(F.xxhash64("id").alias("hash"), F.lit("p").alias("part"))
    runs, _ = locator.add(spark, scratch, 1, entries, [])
    old = [{k: v for k, v in runs[0].items() if k != "slots"} | {"bits": 32768}]
    assert locator.find(spark, scratch, entries.select("hash"), old).count() == 300


def test_a_run_that_takes_in_others_is_shuffled_once(spark, scratch, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    plans, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, p, *a, **k: plans.append((p, w._df)) or real(w, p, *a, **k))
    held_in = [spark.range(300).select(F.xxhash64("id").alias("hash"), F.lit(p).alias("part")) for p in ("p", "q", "p")]
    runs = []
    for k, entries in enumerate(held_in):
        runs, _ = locator.add(spark, scratch, k, entries, runs)
    rows = [df._jdf.queryExecution().optimizedPlan().toString() for p, df in plans if p.endswith("run=1/rows")][0]
    assert rows.index("Aggregate") < rows.index("RepartitionByExpression")
    last = [df for p, df in plans if p.endswith("run=1/rows")][0]._jdf.queryExecution().executedPlan().toString()
    assert last.split("== Initial Plan ==")[-1].count("Exchange") == 1
    assert sorted(r.part for r in locator.find(spark, scratch, held_in[0].select("hash"), runs).select("part").distinct().collect()) == ["p", "q"]


# --- live counts and late rows ---------------------------------------------------------


def test_replayed_groups_change_nothing(spark, scratch):
    def merge(batch, *rows):
        return live.merge_counts(spark, spark.createDataFrame(rows, "dimension string, label string, day date, events long"), batch, scratch, "s")

    merge(0, ("practice", "Tax", D1, 3), ("practice", "Tax", D2, 1))
    assert merge(1, ("practice", "Tax", D1, 5)) == [D1]
    assert merge(1, ("practice", "Tax", D1, 5)) == [] and merge(0, ("practice", "Tax", D1, 3)) == []
    with pytest.raises(ValueError):
        live.merge_counts(spark, spark.createDataFrame([("practice", "Tax", D1, 1)], "dimension string, label string, day date, events long"), 0, scratch, "another")
    got = {(r.label, r.day): (r.events, r.batch) for r in versions.read_table(spark, scratch).collect()}
    assert got == {("Tax", D1): (5, 1), ("Tax", D2): (1, 0)}


def _stream(spark, rows, folder):
    spark.createDataFrame(rows, "usage_id string, utc_time string, practice string").withColumn("utc_time", F.col("utc_time").cast("timestamp_ntz")).write.mode("append").parquet(folder)


def test_counts_stay_right_while_the_watermark_moves(spark, scratch):
    def deliver(*rows):
        _stream(spark, rows, f"{scratch}/in")
        events = spark.readStream.schema("usage_id string, utc_time timestamp_ntz, practice string").parquet(f"{scratch}/in")
        counts = live.dimension_counts(events.withColumn("t", F.col("utc_time").cast("timestamp")), "t", ["practice"], delay="1 day")
        live.keep_dimension_counts(counts, f"{scratch}/counts", f"{scratch}/c").awaitTermination()
        return {(r.label, str(r.day)): r.events for r in versions.read_table(spark, f"{scratch}/counts").collect()}

    deliver(("a", "2024-01-01 10:00:00", "Tax"), ("b", "2024-01-02 10:00:00", None))
    deliver(("c", "2024-01-02 11:00:00", "Tax"), ("d", "2024-01-09 10:00:00", "Tax"), ("n", None, "Tax"))
    got = deliver(("e", "2024-01-01 11:00:00", "Tax"), ("f", "2024-01-09 11:00:00", "Tax"))  # e is behind the watermark
    assert got == {("Tax", "2024-01-01"): 1, ("Unknown", "2024-01-02"): 1, ("Tax", "2024-01-02"): 1, ("Tax", "2024-01-09"): 2}


def _batch(spark, *rows):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d, 12) if d else None) for i, d in rows], "usage_id string, utc_time timestamp_ntz").withColumn("usage_date", F.to_date("utc_time"))


def _split(spark, base, number, *rows):
    live.split_batch(spark, _batch(spark, *rows), number, f"{base}/t", f"{base}/q", ["usage_id"], ["utc_time"], "usage_date", "utc_time", dt.timedelta(days=2), "s")


def _ids(spark, base):
    return sorted(r.usage_id for r in versions.read_table(spark, f"{base}/t").collect())


def test_late_rows_wait_and_are_taken_once(spark, scratch, monkeypatch):
    _split(spark, scratch, 0, ("a", 10), ("b", 1), ("z", None))
    _split(spark, scratch, 1, ("c", 5), ("d", 9), ("e", 12))
    _split(spark, scratch, 2, ("f", 9), ("g", 20))
    _split(spark, scratch, 2, ("f", 9), ("g", 20))  # the batch is run again
    assert _ids(spark, scratch) == ["a", "b", "d", "e", "g", "z"]
    published = versions.publish
    monkeypatch.setattr(versions, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    for _ in range(2):
        with pytest.raises(RuntimeError):
            live.backfill_late(spark, f"{scratch}/t", f"{scratch}/q")
        with pytest.raises(RuntimeError):  # its late row is in the queue, its batch is not in the table
            _split(spark, scratch, 3, ("h", 2), ("i", 21))
    monkeypatch.setattr(versions, "publish", published)
    assert sorted(map(str, live.backfill_late(spark, f"{scratch}/t", f"{scratch}/q"))) == ["2024-01-05", "2024-01-09"]
    assert _ids(spark, scratch) == ["a", "b", "c", "d", "e", "f", "g", "z"]
    assert live.backfill_late(spark, f"{scratch}/t", f"{scratch}/q") == []
    _split(spark, scratch, 3, ("h", 2), ("i", 21))
    assert live.backfill_late(spark, f"{scratch}/t", f"{scratch}/q") == [dt.date(2024, 1, 2)]
    assert _ids(spark, scratch) == ["a", "b", "c", "d", "e", "f", "g", "h", "i", "z"]


# --- bitmaps ---------------------------------------------------------------------------


def test_bitmaps_follow_touched_days(spark, scratch):
    usage, roster = fx.usage(spark, SF001), fx.roster(spark, SF001)
    day = F.col("usage_date")
    usage = usage.withColumn("usage_date", F.when(F.col("usage_id").cast("long") % 10 == 0, F.lit(None).cast("date")).otherwise(day))
    early = usage.where((day < "2024-01-20") | day.isNull())
    bitmaps.refresh(spark, early, roster, scratch)
    names = versions.current(spark, f"{scratch}/events").folders["2024-01-07"]
    later = [r[0] for r in usage.where(day >= "2024-01-20").select("usage_date").distinct().collect()]
    bitmaps.refresh(spark, usage, roster, scratch, touched=later)
    assert versions.current(spark, f"{scratch}/events").folders["2024-01-07"] == names
    filters = [Filters(), Filters(start_date="2024-01-15", end_date="2024-01-25"), Filters(practices=["BUILDING", "MACHINERY"], accesses=["click"], end_date="2024-01-22"), Filters(practices=["none"])]
    for f in filters:
        assert bitmaps.dashboard_kpis(spark, scratch, f).collect() == D.kpis(f.apply(usage)).collect()
        want = A.adoption_kpis(A.roster_activity(roster, usage, f)).collect()[0]
        assert bitmaps.adoption_kpis(spark, scratch, f).collect()[0].asDict() == want.asDict()
    with pytest.raises(ValueError):
        bitmaps.dashboard_kpis(spark, scratch, Filters(products=["Vault"]))


def test_user_numbers_are_dense_and_given_once(spark, scratch):
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "user string")
    first = {r.user: r.no for r in bitmaps._numbers(spark, scratch, names("b", "a")).collect()}
    then = {r.user: r.no for r in bitmaps._numbers(spark, scratch, names("c", "a", "0")).collect()}
    assert first == {"a": 1, "b": 2} and then == {**first, "0": 3, "c": 4}


# --- pages and search ------------------------------------------------------------------


def test_ranked_pages_equal_live_pages(spark, scratch):
    usage = fx.usage(spark, SF001)
    pages.write_ranked(usage, scratch, "Location", True, range_rows=100)
    for f in (None, Filters(practices=["BUILDING"]), Filters(search="user1", start_date="2024-01-10")):
        n = pages.total(spark, scratch, f)
        assert n == D.usage_total(usage, f).first().total
        for page in (1, 2, 6, n // 20 + 1, n // 20 + 2):
            want = D.usage_page(usage, f, "Location", True, page).collect()
            assert pages.ranked_page(spark, scratch, f, "Location", True, page).collect() == want


def test_a_deep_page_reads_its_ranges_only(spark, scratch):
    usage = fx.usage(spark, SF001)
    pages.write_ranked(usage, scratch, range_rows=100)
    plan = pages.ranked_page(spark, scratch, page=48)._jdf.queryExecution().toString()
    parts = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    sizes = spark.read.parquet(f"{scratch}/directory")
    assert sizes.count() > 5 and len(set(re.findall(r"\d+", parts.split("part", 1)[1])) - {""}) <= 3


def test_dictionary_search_equals_a_live_one(spark, scratch, monkeypatch):
    usage = fx.usage(spark, SF001).withColumns({
        "practice": F.when(F.col("usage_id").cast("long") % 9 == 0, F.lit("100%_Ä\\b")).otherwise(F.col("practice")),
        "location": F.when(F.col("usage_id").cast("long") % 8 == 0, F.lit(None).cast("string")).otherwise(F.col("location"))})
    search.refresh(usage.where("usage_date < '2024-01-15'"), scratch)
    days = [r[0] for r in usage.where("usage_date >= '2024-01-15'").select("usage_date").distinct().collect()]
    search.refresh(usage, scratch, touched=days)
    for listed in (200, 1):
        monkeypatch.setattr(search, "LISTED", listed)
        for needle in ["", "u", "us", "USER1", "user1_@", "%", "100\\%", "\\_ä", "r%1@", "nowhere to be found", "a,b", "er#0%0001"]:
            want = sorted(r.usage_id for r in Filters(search=needle).apply(usage).select("usage_id").collect())
            assert sorted(r.usage_id for r in search.search(usage, scratch, needle).select("usage_id").collect()) == want, needle


def test_literal_runs_of_a_pattern():
    assert search.literals("ab_c%\\%d\\\\e") == ["ab", "c", "%d\\e"]
