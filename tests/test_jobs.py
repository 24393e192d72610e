"""End-to-end jobs on the sf0.001 tables."""

import datetime as dt

from pyspark.sql import functions as F

from adoptlens import jobs
from adoptlens.operators.versions import read_table
from adoptlens.sources import fixtures as fx

from paths import SF001


def test_export_extract_append_is_idempotent(spark, scratch):
    raw, roster = fx.raw_events(spark, SF001), fx.roster(spark, SF001)
    out1 = jobs.export_extract(spark, raw, roster, scratch, "2024-01-01", "2024-01-16")
    first = out1["extract"].count()
    out2 = jobs.export_extract(spark, raw, roster, scratch, "2024-01-10", "2024-02-01")
    total = out2["extract"].count()
    expected = raw.filter((F.col("utc_time") >= F.lit("2023-12-31 18:30:00").cast("timestamp_ntz"))
                          & (F.col("utc_time") < F.lit("2024-01-31 18:30:00").cast("timestamp_ntz"))).count()
    assert first < total == expected
    again = jobs.export_extract(spark, raw, roster, scratch, "2024-01-10", "2024-02-01")["extract"].count()
    assert again == total
    a = out2["audit"].collect()[0]
    assert a.matched + a.unmatched == a.rows
    unmatched = spark.read.parquet(f"{scratch}/unmatched").count()
    assert unmatched == spark.read.parquet(f"{scratch}/extract").filter(F.col("workforce_name").isNull()).count()
    assert spark.read.parquet(f"{scratch}/archive/usage_enriched_2024-01-10_to_2024-01-31").count() > 0


def test_sync_window_daily_then_backfill(spark, scratch):
    raw, roster = fx.raw_events(spark, SF001), fx.roster(spark, SF001)
    table, meta = f"{scratch}/usage", f"{scratch}/meta"
    m = jobs.sync_window(spark, raw, roster, table, meta, "2024-01-05", "2024-01-06").collect()[0]
    assert m.min_date == m.max_date == dt.date(2024, 1, 5)
    m = jobs.sync_window(spark, raw, roster, table, meta, "2024-01-01", "2024-02-01").collect()[0]
    m2 = jobs.sync_window(spark, raw, roster, table, meta, "2024-01-01", "2024-02-01").collect()[0]
    assert m.row_count == m2.row_count == fx.usage(spark, SF001).filter(F.col("usage_date") < "2024-02-01").count()
    empty = jobs.sync_window(spark, raw, roster, table, meta, "2030-01-01", "2030-01-02").collect()[0]
    assert empty.row_count == m.row_count and empty.last_sync_rows == 0


def test_import_roster_merges_and_upserts(spark, scratch):
    rows = fx.roster_with_copies(spark, SF001)
    raw = rows.select(F.col("email").alias("Email"), F.col("workforce_name").alias("Workforce Name"),
                      F.col("location").alias("Location"), F.col("practice").alias("Practice/ Function"),
                      F.col("team").alias("Team"), F.col("designation").alias("Designation"),
                      F.col("raw_status").alias("Status"), "src_ord")
    path = f"{scratch}/roster"
    out = jobs.import_roster(spark, raw, path)
    n = out["roster"].count()
    assert n == rows.select("email").distinct().count()
    assert sum(r.n for r in out["state_counts"].collect()) == n
    assert out["duplicates"].count() > 0
    again = jobs.import_roster(spark, raw, path)
    assert again["roster"].count() == n


def test_bulk_import_csv_last_row_wins(spark, scratch):
    from adoptlens.catalog.ingest_q import _extract_text

    ext = _extract_text(spark, SF001)
    # the same ids appear again at the end of the file with another access point
    again = ext.filter(F.trim("unique_usage_id").try_cast("long") % 20 == 0).withColumn("access_point", F.lit("changed"))
    csv = f"{scratch}/extract_csv"
    ext.unionByName(again).coalesce(1).write.option("header", True).csv(csv)
    n = jobs.bulk_import(spark, csv, f"{scratch}/usage")
    table = read_table(spark, f"{scratch}/usage")
    assert n == table.count() == table.select("usage_id").distinct().count()
    ids = [r[0].strip() for r in again.select("unique_usage_id").collect() if r[0].strip()]
    changed = table.filter(F.col("usage_id").isin(ids)).select("access_point").distinct().collect()
    assert [r[0] for r in changed] == ["changed"]


def test_resync_keeps_first_synced_at(spark, scratch):
    raw, roster = fx.raw_events(spark, SF001), fx.roster(spark, SF001)
    table, meta = f"{scratch}/usage", f"{scratch}/meta"
    jobs.sync_window(spark, raw, roster, table, meta, "2024-01-05", "2024-01-06")
    first = {r.usage_id: r.synced_at for r in read_table(spark, table).select("usage_id", "synced_at").collect()}
    jobs.sync_window(spark, raw, roster, table, meta, "2024-01-05", "2024-01-07")
    after = {r.usage_id: r.synced_at for r in read_table(spark, table).select("usage_id", "synced_at").collect()}
    assert all(after[k] == v for k, v in first.items())
    assert len(after) > len(first)


def test_stream_ingest_of_landed_documents(spark, scratch):
    import json
    import os

    from adoptlens.streaming.ingest import ingest_documents

    landing = f"{scratch}/landing".replace("file:", "")
    os.makedirs(landing, exist_ok=True)
    ev = lambda i, t: {"utc_time": t, "user": f" User{i % 7}@example.com ", "unique_usage_id": f"id{i}",
                       "access_point": "web", "product_surface_area": "Assistant", "file_ids": ["a"] * (i % 3)}
    docs = [[ev(i, f"2024-01-0{1 + i % 3}T1{i % 10}:00:00Z") for i in range(0, 20)],
            [ev(i, f"2024-01-0{1 + i % 3}T1{i % 10}:00:00Z") for i in range(10, 30)]]  # ids 10-19 twice
    for n, d in enumerate(docs):
        with open(f"{landing}/doc{n}.json", "w") as fh:
            json.dump({"events": d}, fh)
    roster = fx.roster(spark, SF001)
    q = ingest_documents(spark, landing, roster, f"{scratch}/usage", f"{scratch}/_ckpt")
    q.awaitTermination()
    t = read_table(spark, f"{scratch}/usage")
    assert t.count() == 30 and t.select("usage_id").distinct().count() == 30
    assert t.filter(F.col("user_email") == "user1@example.com").count() > 0
    assert t.filter(F.col("workforce_name").isNotNull()).count() > 0  # roster matched
    assert t.agg(F.sum("file_count")).collect()[0][0] == sum(i % 3 for i in range(30))


def test_stream_daily_counts_dst_zone(spark, scratch):
    from adoptlens.session import scratch_path
    from adoptlens.streaming import ingest as S

    assert S.has_fixed_offset("Asia/Kolkata") and not S.has_fixed_offset("America/New_York")
    schema = spark.read.parquet(f"{SF001}/events.parquet").schema
    src = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF001)
    ev = src.select(S.event_instant(spark, "ts").alias("event_ts"))
    out = scratch_path(spark, "dst")
    q = S.write_complete(S.daily_counts(ev, "event_ts", tz="America/New_York"), f"{out}/o", f"{out}/c")
    q.awaitTermination()
    got = {r.usage_date: r.events for r in spark.read.parquet(f"{out}/o").collect()}
    e = spark.read.parquet(f"{SF001}/events.parquet")
    local = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts")))
    exp = {r[0]: r[1] for r in e.groupBy(local).count().collect()}
    assert got == exp


def test_duplicated_roster_rows_do_not_fan_out(spark, scratch):
    raw, roster = fx.raw_events(spark, SF001), fx.roster(spark, SF001)
    doubled = roster.unionByName(roster)
    out = jobs.export_extract(spark, raw, doubled, scratch, "2024-01-01", "2024-02-01", append=False, archive=False)
    assert out["extract"].count() == out["extract"].select("usage_id").distinct().count()


def test_sync_refreshes_snapshot_incrementally(spark, scratch):
    from adoptlens.plans import dashboard as D
    from adoptlens.plans import snapshots as SN

    raw, roster = fx.raw_events(spark, SF001), fx.roster(spark, SF001)
    table, meta, snap = f"{scratch}/usage", f"{scratch}/meta", f"{scratch}/snap"
    jobs.sync_window(spark, raw, roster, table, meta, "2024-01-01", "2024-01-10", snapshot_root=snap)
    jobs.sync_window(spark, raw, roster, table, meta, "2024-01-10", "2024-01-12", snapshot_root=snap)
    t = read_table(spark, table)
    assert SN.read_section(spark, snap, "dashboard.kpis").collect() == D.kpis(t).collect()
    assert sorted(map(tuple, SN.read_section(spark, snap, "top_users").collect())) == \
        sorted(map(tuple, D.top_users(t).collect()))


def test_bulk_import_reads_quoted_cells(spark, scratch):
    import os

    from adoptlens import jobs

    os.makedirs(f"{scratch}/csv")
    head = "utc_time,user,unique_usage_id,access_point,product_surface_area,file_count\n"
    with open(f"{scratch}/csv/a.csv", "w") as f:
        f.write(head + '2024-01-01T00:00:00+05:30,u@x.com,1,web,"say ""hi"", you",2\n')
        f.write('2024-01-01 10:00:00,u@x.com,2,web,"two\nlines",1\n')
    with open(f"{scratch}/csv/b.csv", "w") as f:
        f.write(head + "2024-01-02 10:00:00,u@x.com,2,app,later file,3\n")
    assert jobs.bulk_import(spark, f"{scratch}/csv", f"{scratch}/t") == 2
    rows = {r.usage_id: r for r in read_table(spark, f"{scratch}/t").collect()}
    assert rows["1"].product_area == 'say "hi", you' and rows["1"].file_count == 2
    assert str(rows["1"].utc_time) == "2023-12-31 18:30:00"
    assert rows["2"].access_point == "app" and rows["2"].file_count == 3


def test_corrected_event_is_stored_once(spark, scratch):
    from adoptlens import jobs

    roster = spark.createDataFrame([("u@x.com", "U")], "email string, workforce_name string")

    def sync(rows, start, end):
        raw = spark.createDataFrame(rows, "usage_id string, utc_time string, user string").withColumn("utc_time", F.col("utc_time").cast("timestamp_ntz"))
        return jobs.sync_window(spark, raw, roster, f"{scratch}/t", f"{scratch}/m", start, end).collect()[0]

    meta = sync([("a", "2024-01-05 10:00:00", "u@x.com"), ("a", "2024-01-05 10:00:00", "u@x.com"), ("b", "2024-01-05 11:00:00", "u@x.com")], "2024-01-05", "2024-01-06")
    assert (meta.row_count, meta.last_sync_rows) == (2, 2)
    sync([("a", "2024-01-07 10:00:00", "u@x.com")], "2024-01-07", "2024-01-08")
    got = sorted((r.usage_id, str(r.usage_date)) for r in read_table(spark, f"{scratch}/t").collect())
    assert got == [("a", "2024-01-07"), ("b", "2024-01-05")]
