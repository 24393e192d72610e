"""Tables that a stream keeps current, and rows that come too late for it.

* ``dimension_counts`` / ``keep_dimension_counts``: events per (dimension, label, local day) as
  an update-mode aggregate. Each micro-batch merges only the groups that changed into a stored
  table, whose ledger records the batch; every group carries the batch it was last set by.
* ``ingest_on_time`` / ``backfill_late``: rows behind the stored watermark are split off into
  a queue. The watermark, the batch's ledger entry and its rows become visible together; the
  back-fill takes each queued batch into the table once, which is recorded the same way.

Batch numbers count within one streaming query, so ledgers name the query by the id that its
checkpoint gives it.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ
from adoptlens.operators import versions
from adoptlens.operators.upsert import upsert_into_table
from adoptlens.plans.dashboard import CHART_DIMS, UNKNOWN
from adoptlens.session import remove_path, scratch_path
from adoptlens.streaming.ingest import has_fixed_offset, local_midnight_offset

COUNT_KEYS = ["dimension", "label", "day"]


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that a checkpoint belongs to; it survives restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def dimension_counts(events: DataFrame, time_col: str, dims: Sequence[str] = CHART_DIMS, tz: str = DEFAULT_TZ,
                     delay: str = "1 day") -> DataFrame:
    """(dimension, label, day, events) of a stream of enriched events; NULL labels are 'Unknown'.

    Days are windows aligned to local midnight where the zone's offset is fixed, so that state
    behind the watermark is dropped; other zones group by the local date and keep their state.
    """
    session_tz = events.sparkSession.conf.get("spark.sql.session.timeZone")
    pair = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit(UNKNOWN)).alias("label")) for d in dims]))
    pairs = events.withWatermark(time_col, delay).select(time_col, pair.alias("p")).select(time_col, "p.dimension", "p.label")

    def local(c):
        return F.to_date(F.convert_timezone(F.lit(session_tz), F.lit(tz), F.col(c).cast("timestamp_ntz")))

    if not has_fixed_offset(tz):
        return pairs.where(F.col(time_col).isNotNull()).groupBy("dimension", "label", local(time_col).alias("day")).agg(F.count(F.lit(1)).alias("events"))
    window = F.window(time_col, "1 day", "1 day", local_midnight_offset(tz)).alias("w")
    counts = pairs.groupBy(window, "dimension", "label").agg(F.count(F.lit(1)).alias("events"))
    return counts.select("dimension", "label", local("w.start").alias("day"), "events")


def merge_counts(spark: SparkSession, groups: DataFrame, batch_id: int, table_path: str, source: str) -> list:
    """Set the changed ``groups`` of one batch; a batch that was merged before changes nothing,
    and no group goes back to the count of an earlier batch. Returns the days that changed.

    A query's counts start from its own first batch, so a table is kept by one query only.
    """
    state = versions.current(spark, table_path)
    if state is not None and set(state.ledger) - {source}:
        raise ValueError(f"the counts at {table_path} are kept by another query")
    rows = groups.withColumn("batch", F.lit(batch_id).cast("long"))
    return upsert_into_table(spark, table_path, rows, COUNT_KEYS, ["batch"], "day", ledger=(source, batch_id), newer_by="batch")


def keep_dimension_counts(counts: DataFrame, table_path: str, checkpoint: str):
    """Start the query that keeps the stored counts current (``versions.read_table`` reads them)."""
    spark = counts.sparkSession

    def merge(df: DataFrame, batch_id: int) -> None:
        merge_counts(spark, df, batch_id, table_path, query_id(spark, checkpoint))

    return (counts.writeStream.outputMode("update").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _stamp(time: dt.datetime) -> str:
    return time.isoformat(sep=" ", timespec="microseconds")


def split_batch(spark: SparkSession, batch: DataFrame, batch_id: int, table_path: str, queue_path: str, keys: Sequence[str],
                order_cols: Sequence[str], partition_col: str, time_col: str, delay: dt.timedelta, source: str) -> None:
    """One batch of ``ingest_on_time``: rows behind the watermark to the queue, the others to the table."""
    state = versions.current(spark, table_path)
    if state is not None and state.ledger.get(source, -1) >= batch_id:
        return
    behind = state.marks.get("watermark") if state is not None else None
    staged = scratch_path(spark, "batch")
    batch.write.parquet(staged)
    rows = spark.read.schema(batch.schema).parquet(staged)
    late = F.lit(False)
    if behind is not None:
        late = F.coalesce(F.col(time_col) < F.lit(behind).cast("timestamp_ntz"), F.lit(False))
    newest = rows.agg(F.max(time_col)).first()[0]
    marks = [behind] if newest is None else [behind, _stamp(newest - delay)]
    # before the table: a batch that is run again overwrites what it left in the queue
    rows.where(late).write.mode("overwrite").parquet(f"{queue_path.rstrip('/')}/{source}.{batch_id}")
    upsert_into_table(spark, table_path, rows.where(~late), keys, order_cols, partition_col, ledger=(source, batch_id),
                      marks={"watermark": max((m for m in marks if m is not None), default=None)})
    remove_path(spark, staged)


def ingest_on_time(rows: DataFrame, table_path: str, queue_path: str, checkpoint: str, keys: Sequence[str] = ("usage_id",),
                   order_cols: Sequence[str] = ("utc_time",), partition_col: str = "usage_date", time_col: str = "utc_time",
                   delay: dt.timedelta = dt.timedelta(days=1)):
    """Start the ingest of rows that are at most ``delay`` older than the newest of the batches before;
    later ones wait in ``queue_path``. Rows without a time are never late."""
    spark = rows.sparkSession

    def merge(df: DataFrame, batch_id: int) -> None:
        split_batch(spark, df, batch_id, table_path, queue_path, keys, order_cols, partition_col, time_col, delay, query_id(spark, checkpoint))

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def backfill_late(spark: SparkSession, table_path: str, queue_path: str, keys: Sequence[str] = ("usage_id",),
                  order_cols: Sequence[str] = ("utc_time",), partition_col: str = "usage_date", prepare=lambda df: df) -> list:
    """Take every queued batch into the table, exactly once; returns the partition values that changed.

    A batch is taken only after its on-time rows are in the table, and what was taken is
    published with the rows themselves; ``prepare`` maps the rows before.
    """
    state, base = versions.current(spark, table_path), queue_path.rstrip("/")
    if state is None:
        return []
    queued = set(versions._names(spark, base))
    done = set(state.marks.get("consumed", []))
    told = {name: name.rsplit(".", 1) for name in queued - done}
    ready = sorted(name for name, (source, batch) in told.items() if int(batch) <= state.ledger.get(source, -1))
    touched = []
    if ready:
        rows = spark.read.schema(state.schema).parquet(*[f"{base}/{name}" for name in ready])
        touched = upsert_into_table(spark, table_path, prepare(rows), keys, order_cols, partition_col, marks={"consumed": ready})
    for name in ready + sorted(queued & done):
        remove_path(spark, f"{base}/{name}")
    return touched
