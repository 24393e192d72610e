"""Streaming queries: `events` arrives twice (two file sources over the same file), is run
to completion with availableNow, and the sink is read back as a batch table."""

from __future__ import annotations

from pyspark.sql import functions as F

from adoptlens.catalog import register
from adoptlens.operators.enrich import normalize_events
from adoptlens.operators.versions import read_table
from adoptlens.session import scratch_path
from adoptlens.sources.fixtures import event_user, product_area_expr
from adoptlens.sources.tables import table
from adoptlens.streaming import ingest as S


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .option("maxFilesPerTrigger", 1).parquet(sf))
    return src


def _as_raw(df):
    eid = F.col("event_id")
    return df.select(
        eid.cast("string").alias("usage_id"),
        F.col("ts").alias("utc_time"),
        event_user(F.col("user_id")).alias("user"),
        F.col("event_type").alias("access_point"),
        product_area_expr(eid).alias("product_area"),
        (eid % 4).cast("int").alias("file_count"),
    )


INGEST_COLS = ["usage_id", "utc_time", "user_email", "access_point", "product_area", "file_count", "usage_date", "usage_hour"]


@register("stream_ingest", """
SELECT CAST(event_id AS VARCHAR) AS usage_id, ts AS utc_time, 'user' || CAST(user_id AS VARCHAR) || CASE WHEN user_id % 13 = 6 THEN '@partner.example' ELSE '@example.com' END AS user_email,
       event_type AS access_point,
       CASE event_id % 12 WHEN 0 THEN 'Assistant' WHEN 1 THEN 'Assistant, Follow-up' WHEN 2 THEN 'Word Add-In'
            WHEN 3 THEN 'Workflow Builder,Review Table' WHEN 4 THEN 'Playbook' WHEN 5 THEN 'Vault'
            WHEN 6 THEN 'Vault, Vault' WHEN 7 THEN ' , ' WHEN 8 THEN '' WHEN 9 THEN NULL
            WHEN 10 THEN 'Knowledge,History,Thread' ELSE 'Research,Translate' END AS product_area,
       CAST(event_id % 4 AS INT) AS file_count,
       CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date,
       CAST(EXTRACT(HOUR FROM ts + INTERVAL '330' MINUTE) AS INT) AS usage_hour
FROM events""")
def q_stream_ingest(spark, sf):
    base = scratch_path(spark, "stream-ingest")
    rows = normalize_events(_as_raw(_event_stream(spark, sf)).unionByName(_as_raw(_event_stream(spark, sf))))
    q = S.ingest(rows.select(*INGEST_COLS), f"{base}/table", f"{base}/_checkpoint")
    q.awaitTermination()
    return read_table(spark, f"{base}/table").select(*INGEST_COLS)


@register("stream_dedupe", """
SELECT CAST(event_id AS VARCHAR) AS usage_id, ts AS utc_time, user_id FROM events""")
def q_stream_dedupe(spark, sf):
    base = scratch_path(spark, "stream-dedupe")
    both = _event_stream(spark, sf).unionByName(_event_stream(spark, sf))
    ev = both.select(F.col("event_id").cast("string").alias("usage_id"), F.col("ts").alias("utc_time"), "user_id",
                     S.event_instant(spark, "ts").alias("event_ts"))
    d = S.dedupe_stream(ev, "usage_id", "event_ts").drop("event_ts")
    q = (d.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("stream_daily_counts", """
SELECT CAST(ts + INTERVAL '330' MINUTE AS DATE) AS usage_date, COUNT(*) AS events
FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def q_stream_daily_counts(spark, sf):
    base = scratch_path(spark, "stream-daily")
    ev = _event_stream(spark, sf).select(S.event_instant(spark, "ts").alias("event_ts"))
    q = S.write_complete(S.daily_counts(ev, "event_ts"), f"{base}/out", f"{base}/_checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
