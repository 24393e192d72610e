"""Operator 10, packing: token pieces laid into windows by non-negative least squares.

Each document is cut into whole windows and one remainder. Only the histogram of remainder
lengths (at most ``window`` - 1 counts) reaches the driver. Shallow combinations of lengths
that fill a window are enumerated, their repeat counts are solved against the histogram by
non-negative least squares and rounded, and what is left is packed greedily, again on counts.
The resulting plan says which sequence the n-th piece of each length goes to; pieces are
numbered by length with a prefix sum over the tasks' counts, so no piece is ever sorted or
gathered.

Null text counts as empty; every row is its own document, repeated rows and null ids too; an
empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptlens.llm.tables import stored
from adoptlens.llm.tokens import text_blocks, worker_tokenizer

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, place long"
#: Steps of the projected gradient for the least squares, and triples and fours tried per length.
STEPS, DEEPER = 300, 16


def pieces(docs: DataFrame, tokenizer_path: str, window: int, end_id: int) -> DataFrame:
    """Windows and remainder of each document, numbered by length within their task."""

    def cut(batches):
        tokenizer = worker_tokenizer(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for block in text_blocks(batches):
            ids, starts = tokenizer.encode(block.column("text").to_pylist())
            out = []
            for doc_id, a, b in zip(block.column("doc_id").to_pylist(), starts[:-1], starts[1:]):
                own = np.append(ids[a:b], end_id).astype("<u4")
                for at in range(0, len(own), window):
                    piece = own[at : at + window]
                    out.append((doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(own), part, int(seen[len(piece)])))
                    seen[len(piece)] += 1
            columns = list(zip(*out))
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def combinations(counts: np.ndarray, window: int) -> np.ndarray:
    """Shallow combinations that fill a window exactly: rows of up to four lengths, zero where fewer.

    All pairs; threes and fours around the ``DEEPER`` most common partners of each length.
    """
    have = np.flatnonzero(counts)
    common = have[np.argsort(-counts[have], kind="stable")][:DEEPER]
    i, j = np.triu_indices(len(common))
    # what is combined with each length: nothing, a common one, two common ones
    first = np.concatenate([[0], common, common[i]])
    second = np.concatenate([[0], np.zeros(len(common), int), common[j]])
    found = []
    for a, b in zip(first, second):
        last = window - have - a - b
        fits = (last > 0) & (last < len(counts))
        fits[fits] = counts[last[fits]] > 0
        rows = np.stack([have[fits], last[fits], np.full(fits.sum(), a), np.full(fits.sum(), b)], axis=1)
        found.append(-np.sort(-rows, axis=1))
    every = np.concatenate(found)
    # one number per row, so that equal rows are found by a plain sort
    weights = (window + 1) ** np.arange(3, -1, -1, dtype=np.int64)
    _, at = np.unique(every @ weights, return_index=True)
    return every[at]


def repeats(combos: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative least squares: how often each combination best uses up the histogram."""
    x = np.zeros(len(combos))
    if not len(combos):
        return x
    size, used = len(counts), combos > 0
    row, flat = np.nonzero(used)[0], combos[used]
    # a column's step is bounded by how many columns share its lengths
    share = np.bincount(flat, minlength=size)
    step = 1.0 / np.maximum(1, np.bincount(row, weights=share[flat], minlength=len(combos)))
    target = counts.astype(float)
    for _ in range(STEPS):
        left = target - np.bincount(flat, weights=x[row], minlength=size)
        x = np.maximum(0, x + step * np.bincount(row, weights=left[flat], minlength=len(combos)))
    return x


def plan(counts: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """Sequences as (lengths, times): rounded least squares, then the rest greedily."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[list[int], int]] = []

    def use(lengths: list[int], times: int) -> None:
        out.append((lengths, times))
        for n in lengths:
            left[n] -= times

    def most(lengths: list[int]) -> int:
        return min(int(left[n]) // lengths.count(n) for n in lengths)

    combos = combinations(counts, window)
    x = repeats(combos, counts)
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 0.5:
            break
        lengths = [int(n) for n in combos[i] if n]
        if (times := min(int(x[i] + 0.5), most(lengths))) > 0:
            use(lengths, times)
    have = [int(n) for n in np.flatnonzero(left)]
    while have:
        lengths, room, taken = [have[-1]], window - have[-1], {have[-1]: 1}
        while (k := bisect_right(have, room)) > 0:
            n = have[k - 1]
            while left[n] <= taken.get(n, 0):
                k -= 1
                if k <= 0:
                    break
                n = have[k - 1]
            if k <= 0:
                break
            lengths.append(n)
            taken[n] = taken.get(n, 0) + 1
            room -= n
        use(lengths, most(lengths))
        have = [n for n in have if left[n] > 0]
    return out


def plan_table(sequences: list[tuple[list[int], int]]) -> np.ndarray:
    """Per slot: length, first rank it takes, sequence of that rank, offset; sorted for search."""
    next_rank: dict[int, int] = {}
    rows, base = [], 0
    for lengths, times in sequences:
        offset = 0
        for n in lengths:
            rows.append((n, next_rank.get(n, 0), base, offset))
            next_rank[n] = next_rank.get(n, 0) + times
            offset += n
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, at which offset."""
    cut = stored(pieces(docs, tokenizer_path, window, end_id), "pieces")
    by_task = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(window + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``window`` rows
        counts[length] = n
    counts[window] = 0
    sequences = plan(counts, window)
    first_full = sum(times for _, times in sequences)
    slots = docs.sparkSession.sparkContext.broadcast(plan_table(sequences))  # at most a few slots a length and combination

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["part", "length"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("place") + F.col("before")).alias("rank"))

    def place(batches):
        table = slots.value
        key = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            full = length == window
            if len(table):
                at = np.maximum(0, np.searchsorted(key, (length << 48) + rank, side="right") - 1)
                sequence, offset = table[at, 2] + rank - table[at, 1], table[at, 3]
            else:
                sequence, offset = rank, np.zeros_like(rank)
            sequence = np.where(full, first_full + rank, sequence)
            offset = np.where(full, 0, offset)
            yield pa.record_batch(batch.columns[:-1] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=batch.schema.names[:-1] + ["sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
