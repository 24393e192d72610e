"""Quoted CSV read by many tasks, line breaks inside cells included.

A byte range of a CSV file does not tell whether it begins inside a quoted cell; the number of
quotes before it does (a quote inside a cell is doubled, so the parity holds). One pass counts
the quotes of every range, a prefix sum over the ranges of a file gives the parity each begins
with, and a second pass puts lines together into records from there on. Only what a range's
border divides, one record per border, is moved and joined.

Quoting is that of RFC 4180; lines end with LF or CR LF; every file has its own header, in the
first file's order.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adoptlens.session import scratch_path

RECORDS = "file string, block long, id long, text string, head boolean, tail boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, value, quotes): every line, the range it begins in, and an id that grows within it."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("id"), "value",
                        (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))).cast("long").alias("quotes"))


def _begins_inside(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether a range begins within a quoted cell; one row per range."""
    sums = lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Open:
    """The record that a range's lines so far have left open."""

    def __init__(self, key, inside: bool):
        self.key, self.parity, self.head = key, int(inside), inside
        self.first, self.parts = None, []


def _records(batches):
    """Records and the parts of records that a range's borders divide (head: begun before, tail: not ended)."""
    names = ["file", "block", "id", "text", "head", "tail"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]

    def batch_of(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def closed(open_, tail: bool):
        return (*open_.key, open_.first, "\n".join(open_.parts), open_.head, tail)

    open_ = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block")
        change = np.flatnonzero(np.diff(block.to_numpy()) != 0) + 1 if batch.num_rows > 1 else np.zeros(0, int)
        files = pc.dictionary_encode(file).indices.to_numpy(zero_copy_only=False)
        change = np.union1d(change, np.flatnonzero(np.diff(files) != 0) + 1)
        for a, b in zip(np.append(0, change), np.append(change, batch.num_rows)):
            part, out = batch.slice(int(a), int(b - a)), []
            key = (part.column("file")[0].as_py(), part.column("block")[0].as_py())
            if open_ is None or open_.key != key:
                if open_ is not None and open_.parts:
                    out.append(closed(open_, True))
                open_ = _Open(key, part.column("inside")[0].as_py())
            quotes = part.column("quotes").to_numpy()
            after = (open_.parity + np.cumsum(quotes)) % 2
            before = np.append(open_.parity, after[:-1])
            whole = (before == 0) & (after == 0)
            if whole.any():
                alone = part.filter(pa.array(whole))
                no = pa.array(np.zeros(alone.num_rows, bool))
                yield pa.record_batch([*(alone.column(c) for c in ("file", "block", "id", "value")), no, no], names=names)
            rest = part.filter(pa.array(~whole))
            for i, value, end in zip(rest.column("id").to_pylist(), rest.column("value").to_pylist(), after[~whole].tolist()):
                open_.first = i if open_.first is None else open_.first
                open_.parts.append(value)
                if not end:
                    out.append(closed(open_, False))
                    open_.head, open_.first, open_.parts = False, None, []
            open_.parity = int(after[-1])
            if out:
                yield batch_of(out)
    if open_ is not None and open_.parts:
        yield batch_of([closed(open_, True)])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, text): every CSV record of the files, with the place where it begins.

    The lines are read and put together once, into a table in the shared folder (``scratch_scope``).
    """
    lines = _lines(spark, path)
    # one row per range, as the driver's list of the files has: the lines stay where they are read, in order
    begins = F.broadcast(_begins_inside(lines))
    same = F.coalesce("inside", F.raise_error(F.lit("the ranges of the files changed between two reads")).cast("boolean"))
    told = lines.join(begins, ["file", "block"], "left").withColumn("inside", same)
    stored = scratch_path(spark, "csv-records")
    told.mapInArrow(_records, RECORDS).write.parquet(stored)
    parts = spark.read.schema(RECORDS).parquet(stored)
    whole = parts.where("not head and not tail").select("file", "block", "id", "text")
    by_place = Window.partitionBy("file").orderBy("block", "id")
    divided = parts.where("head or tail").withColumn("record", F.count_if(~F.col("head")).over(by_place))
    piece = F.struct("block", "id", "text")
    joined = divided.groupBy("file", "record").agg(F.array_sort(F.collect_list(piece)).alias("parts"))  # as many as the ranges it spans
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return whole.unionByName(joined.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["id"].alias("id"), text.alias("text")))


def read_quoted_csv(spark: SparkSession, path: str, ord_col: str | None = None) -> DataFrame:
    """All records as text columns, header names trimmed; with ``ord_col`` their order over the files."""
    found = records(spark, path).withColumn("text", F.regexp_replace("text", "\r$", "")).where(F.col("text") != "")
    first = found.where("block = 0").groupBy("file").agg(F.min_by("text", "id").alias("text"), F.min("id").alias("id"))
    header = first.orderBy("file").first()
    if header is None:
        return spark.createDataFrame([], StructType([]))
    names = [c.strip().lstrip("﻿").strip() for c in next(csv.reader([header.text]))]
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    heads = first.select("file", F.lit(0).cast("long").alias("block"), "id")  # one row per file
    rows = found.join(F.broadcast(heads), ["file", "block", "id"], "left_anti")
    cells = F.from_csv("text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"quote": '"', "escape": '"', "multiLine": "true"})
    order = F.struct(F.col("file"), F.col("block").alias("split"), F.col("id").alias("row"))
    out = rows.select(cells.alias("c"), order.alias("__order"))
    columns = [F.col(f"c.c{i}").alias(n) for i, n in enumerate(names)]
    return out.select(*columns, *([F.col("__order").alias(ord_col)] if ord_col else []))
