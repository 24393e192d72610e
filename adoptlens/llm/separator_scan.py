"""Operator 3, token counts by separator scan over flat, unindexed token files.

A file is a stream of token ids in which an end-of-document id closes each document; nothing
says where documents start. Blocks of ids are searched for the separator with one vector
comparison each; a prefix scan over the blocks' totals (two levels, so that a file of any
length is spread over many tasks) then stitches documents that cross block boundaries.

Null texts are written as empty documents; ids after a file's last separator are an open
document; an empty table or file gives no rows; repeated rows and null ids are documents of
their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adoptlens.llm.tables import stored
from adoptlens.llm.tokens import text_blocks, worker_tokenizer

BLOCKS = "file string, block long, ids binary"
#: Ids in a block; blocks that the first level of the prefix scan takes together.
BLOCK, RUN = 1 << 18, 256


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, block: int = BLOCK) -> DataFrame:
    """Each task's documents as one flat stream of 16-bit ids, in blocks that ignore documents."""

    def encode(batches):
        tokenizer = worker_tokenizer(tokenizer_path, True)
        name, at, rest = f"part-{TaskContext.get().partitionId():06d}", 0, np.zeros(0, "<u2")

        def rows(parts):
            first = pa.array(range(at, at + len(parts)), pa.int64())
            return pa.record_batch([pa.array([name] * len(parts)), first, pa.array([p.tobytes() for p in parts], pa.binary())], names=["file", "block", "ids"])

        for texts in text_blocks(batches):
            ids, starts = tokenizer.encode(texts.column("text").to_pylist())
            closed = np.insert(ids, starts[1:], end_id).astype("<u2")
            rest = np.concatenate([rest, closed])
            full = len(rest) // block
            if full:
                yield rows([rest[i * block : (i + 1) * block] for i in range(full)])
                at, rest = at + full, rest[full * block :]
        if len(rest):
            yield rows([rest])

    return docs.select("text").mapInArrow(encode, BLOCKS)


def read_files(spark: SparkSession, path: str, block: int = BLOCK, width: int = 2) -> DataFrame:
    """Blocks of flat files of little-endian ids of ``width`` bytes, each below 2 GB."""

    def cut(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                for at in range(0, len(content), block * width):
                    yield pa.record_batch([pa.array([name]), pa.array([at // (block * width)], pa.int64()), pa.array([content[at : at + block * width]], pa.binary())], names=["file", "block", "ids"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(cut, BLOCKS)


def _search(blocks: DataFrame, end_id: int, width: int) -> DataFrame:
    def search(batches):
        for batch in batches:
            found, sizes = [], []
            for raw in batch.column("ids").to_pylist():
                ids = np.frombuffer(raw or b"", f"<u{width}")
                found.append(np.flatnonzero(ids == end_id))
                sizes.append(len(ids))
            yield pa.record_batch([batch.column("file"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["file", "block", "size", "ends"])

    return blocks.mapInArrow(search, "file string, block long, size long, ends array<long>")


def scan(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed): every document of every file.

    ``start``: ids before it in the file; ``n_tokens``: without the separator.
    """
    found = _search(blocks, end_id, width).withColumn("run", F.floor(F.col("block") / RUN))
    found = stored(found, "separators")
    last = F.try_element_at("ends", F.lit(-1))
    n = F.size("ends").cast("long")
    inner = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)

    def before(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # first level: within a run of blocks, from the run's own beginning
    rows = found.withColumns({"n": n, "from": before("size", inner), "docs": before(n, inner)})
    rows = rows.withColumn("close", F.max(F.col("from") + last).over(inner))
    # second level: the runs of a file
    totals = found.groupBy("file", "run").agg(F.sum("size").alias("run_size"), F.sum(n).alias("run_docs"))
    closes = rows.groupBy("file", "run").agg(F.max(F.col("from") + last).alias("run_close"))
    totals = totals.join(closes, ["file", "run"]).withColumns({"run_from": before("run_size", outer), "run_docs_before": before("run_docs", outer)})
    totals = totals.withColumn("close_before", F.max(F.col("run_from") + F.col("run_close")).over(outer)).select("file", "run", "run_from", "run_docs_before", "close_before")
    rows = rows.join(totals, ["file", "run"])
    begin = F.coalesce(F.col("run_from") + F.col("close"), F.col("close_before"), F.lit(-1)) + 1
    place = F.col("run_from") + F.col("from")
    starts = F.concat(F.array(begin), F.transform("ends", lambda e: place + e + 1))
    rows = rows.select("file", "block", place.alias("place"), "size", "ends", starts.alias("starts"), (F.col("run_docs_before") + F.col("docs")).alias("docs"))
    closed = rows.select("file", "docs", "place", "starts", F.posexplode("ends").alias("i", "end"))
    closed = closed.select("file", (F.col("docs") + F.col("i")).alias("ordinal"), F.get("starts", F.col("i")).alias("start"), (F.col("place") + F.col("end")).alias("end"), F.lit(True).alias("closed"))
    ends = rows.groupBy("file").agg(F.max(F.col("docs") + F.size("ends")).alias("ordinal"), F.max(F.element_at("starts", -1)).alias("start"), F.max(F.col("place") + F.col("size")).alias("end"))
    open_ = ends.where("end > start").select("file", "ordinal", "start", "end", F.lit(False).alias("closed"))
    return closed.union(open_).select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "closed")
