"""Keyed upsert into a versioned, date-partitioned Parquet table (Parquet has no MERGE).

Only the touched partitions are rewritten: those the batch writes to plus those that still
hold an older version of a batch key (a corrected event whose day changed leaves its old
partition). The latter come from the table's locator (``locator``), so partitions that hold
none of the batch's keys are not read at all. The merged partitions are written once, under a
new version, and published with the batch's ledger entry by one rename (``versions``): readers
and a writer that dies in between see the table before or after, never an event on two days.
Re-running a batch gives the same table. A null partition value is a partition like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adoptlens.operators import locator, versions
from adoptlens.operators.dedupe import keep_last
from adoptlens.operators.versions import NULL_FOLDER, Version, as_text, read_table
from adoptlens.session import path_exists, remove_path, scratch_path

__all__ = ["read_table", "upsert_into_table"]


def _schema_with(stored: StructType, incoming: StructType, partition_col: str) -> StructType:
    """The stored columns, with the partition column last and in the batch's type (folder names have none)."""
    columns = [f for f in stored.fields if f.name != partition_col]
    return StructType([*columns, StructField(partition_col, incoming[partition_col].dataType)])


def _values(df: DataFrame, column: str) -> list:
    """Distinct partition values: as many as the table has folders to rewrite."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _entries(df: DataFrame, keys: Sequence[str], partition_col: str) -> DataFrame:
    part = F.coalesce(F.col(partition_col).cast("string"), F.lit(NULL_FOLDER))
    return df.select(locator.key_hash(keys).alias("hash"), part.alias("part"))


def _converted(spark: SparkSession, path: str, keys: Sequence[str], partition_col: str, batch: StructType, layout) -> Version:
    """A plain Parquet table made a versioned one; raises if it cannot be read."""
    plain = spark.read.parquet(path)
    schema = _schema_with(plain.schema, batch, partition_col)
    rows = spark.read.schema(schema).parquet(path).select(*schema.names)
    version = Version(1, schema, partition_col, versions.write_partitions(layout(rows), path, 1, partition_col))
    runs, _ = locator.add(spark, path, 1, _entries(versions.read_folders(spark, path, version), keys, partition_col), [])
    old = [n for n in versions._names(spark, path) if not n.startswith("_")]
    version = versions.publish(spark, path, Version(1, schema, partition_col, version.folders, runs=runs))
    for name in old:
        remove_path(spark, f"{path.rstrip('/')}/{name}")
    return version


def upsert_into_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                      order_cols: Sequence[str], partition_col: str,
                      keep_existing: Sequence[str] = (), cluster_by: Sequence[str] = (),
                      ledger: tuple[str, int] | None = None, marks: dict | None = None,
                      newer_by: str | None = None) -> list:
    """Merge ``batch`` into the table at ``path``: per key the batch row wins (last one by
    ``order_cols`` inside the batch); other rows and untouched partitions stay as they are.
    Returns the partition values that changed.

    An older version of a key is found by the key alone, in whatever partition it lies. A table
    that exists but cannot be read raises; only a path without anything starts a new one; a
    plain Parquet table is made a versioned one first.

    ``keep_existing``: columns whose stored value survives an update of the row (e.g. the
    first-insert ``synced_at`` stamp); new keys take the batch's value.

    ``cluster_by``: sort order inside each written file, so Parquet row-group statistics on
    these columns let later filters skip row groups.

    ``ledger``: (source, batch number); a batch whose number the table has already applied
    from that source changes nothing. ``marks``: values of the writer's own that are published
    with the batch. ``newer_by``: a stored row stays if it is greater in this column.
    """
    keys = list(keys)

    def layout(df: DataFrame) -> DataFrame:
        # REBALANCE: one writer group per partition value, but AQE splits a hot value across
        # tasks instead of funnelling it into one; then cluster rows inside each file.
        df = df.hint("rebalance", partition_col)
        inner = [c for c in cluster_by if c in df.columns]
        return df.sortWithinPartitions(partition_col, *inner) if inner else df

    before = versions.current(spark, path)
    if before is None and path_exists(spark, path):
        before = _converted(spark, path, keys, partition_col, batch.schema, layout)
    if before is not None and ledger and before.ledger.get(ledger[0], -1) >= ledger[1]:
        return []

    if batch.schema[partition_col].dataType == StringType():  # both have the same folder
        batch = batch.withColumn(partition_col, F.nullif(F.col(partition_col), F.lit("")))
    newest = keep_last(batch, keys, list(order_cols))
    # the de-duplicated batch is written once; every later step reads it
    batch_path, found_path, unknown_path = (scratch_path(spark, f"upsert-{k}") for k in ("batch", "found", "unknown"))
    newest.write.parquet(batch_path)
    batch_d = spark.read.schema(newest.schema).parquet(batch_path)
    try:
        if before is None:
            schema = _schema_with(newest.schema, newest.schema, partition_col)
            before = Version(0, schema, partition_col, {})
        schema = _schema_with(before.schema, newest.schema, partition_col)
        columns = schema.names
        batch_d = batch_d.select(*columns)
        entries = _entries(batch_d, keys, partition_col)
        number, own, n = before.number + 1, _values(batch_d, partition_col), batch_d.count()
        touched, unknown = own, entries
        if before.runs:
            locator.find(spark, path, entries.select("hash"), before.runs, n).write.parquet(found_path)
            found = spark.read.schema("hash long, part string").parquet(found_path)
            named = {r.part for r in found.select("part").distinct().collect()} - {as_text(v) for v in own}
            if named:  # whether the keys themselves lie there
                near = versions.read_folders(spark, path, before, named).select(*keys, partition_col)
                touched = own + _values(near.join(locator.short(batch_d.select(*keys), n), keys, "left_semi"), partition_col)
            entries.join(locator.short(found, found.count()), ["hash", "part"], "left_anti").write.parquet(unknown_path)
            unknown = spark.read.schema(found.schema).parquet(unknown_path)
        texts = {as_text(v) for v in touched}
        affected = versions.read_folders(spark, path, before, texts)
        incoming = batch_d
        if newer_by:
            stored = locator.short(affected.select(*keys, F.col(newer_by).alias("_newest")), affected.count())
            incoming = batch_d.join(stored, keys, "left").where(F.col("_newest").isNull() | (F.col("_newest") <= F.col(newer_by))).drop("_newest")
        replaced = locator.short(incoming.select(*keys), n)
        if keep_existing:
            old = locator.short(affected.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep_existing]), affected.count())
            incoming = incoming.join(old, keys, "left").select(
                *[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in keep_existing else F.col(c)
                  for c in columns])
        merged = affected.join(replaced, keys, "left_anti").unionByName(incoming)
        written = versions.write_partitions(layout(merged), path, number, partition_col)
        runs, taken = locator.add(spark, path, number, unknown, before.runs)
        unused = [f for v, f in before.folders.items() if v in texts] + taken
        folders = {**{v: f for v, f in before.folders.items() if v not in texts}, **written}
        applied = {**before.ledger, **({ledger[0]: ledger[1]} if ledger else {})}
        after = Version(number, schema, partition_col, folders, applied, {**before.marks, **(marks or {})}, runs, before.retired)
        versions.publish(spark, path, after, unused)
        return touched
    finally:
        remove_path(spark, batch_path)
        remove_path(spark, found_path)
        remove_path(spark, unknown_path)
