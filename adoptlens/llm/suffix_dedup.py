"""Operator 9, suffix-array dedup by bucket-pointer refinement.

The texts that may repeat meet in blocks, and the suffixes of a block are sorted as far as the
window reaches: buckets of equal q-grams first, then every bucket with more than one suffix is
refined by sorting on the bucket identifiers ``step`` bytes later. Refined identifiers are
written back and used by the next, deeper round, so the depth doubles. Suffixes that share a
bucket at depth ``window`` start with the same string; all but those of the smallest document
are removed.

Null text counts as empty; matches never cross documents; empty tables give no rows; repeated
rows and rows that share an id do not remove each other. See ``repeats`` for null ids and for
how texts meet.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from adoptlens.llm import repeats

Q = 8


def _ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each value among the distinct ones, and how many those are."""
    order = np.argsort(values)
    sorted_ = values[order]
    ids = np.empty(len(values), np.int64)
    ids[order] = np.cumsum(np.append(False, sorted_[1:] != sorted_[:-1])[: len(values)])
    return ids, int(ids.max(initial=-1)) + 1


def buckets(held: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that reach ``window`` symbols, and a bucket identifier for each.

    Equal identifiers: equal strings of ``window`` symbols. A suffix alone in its bucket is
    not refined any further.
    """
    n = len(held)
    room = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    q = min(Q, window)
    code = np.zeros(n, np.uint64)
    for j in range(q):
        code[: n - j] = (code[: n - j] << np.uint64(8)) | held[j:]
    live = np.flatnonzero(room >= q)
    pointer = np.full(n, -1, np.int64)
    pointer[live], top = _ranks(code[live])
    depth = q
    while depth < window:
        step = min(depth, window - depth)
        live = live[room[live] >= depth + step]
        live = live[np.bincount(pointer[live], minlength=top)[pointer[live]] > 1]
        ids, new = _ranks((pointer[live] * np.int64(top) + pointer[live + step]).view(np.uint64))
        # fresh identifiers above all earlier ones; a suffix alone in its bucket keeps its own
        pointer[live] = ids + top
        depth, top = depth + step, top + new
    live = np.flatnonzero(room >= window)
    return live, pointer[live]


def _resolve(held, first, doc, window):
    at, bucket = buckets(held, first, window)
    removed = np.zeros(len(held), bool)
    if len(at):
        own = doc[np.searchsorted(first, at, side="right") - 1]
        least = np.full(int(bucket.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, bucket, own)
        removed[at] = own > least[bucket]
    return removed


def _kept(raw: bytes, gone: np.ndarray, _) -> bytes:
    return np.frombuffer(raw, np.uint8)[~gone].tobytes()


def dedup(docs: DataFrame, window: int = 50, keep_text: bool = False) -> DataFrame:
    """``docs`` with bytes, removed bytes, spans in bytes and the digest of the kept bytes."""
    scheme = repeats.Scheme(window, max(1, window * 2 // 5), False)
    return repeats.apply(docs, repeats.repeated(docs, scheme, _resolve), scheme, _kept, keep_text)


def cut(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` and ``n_chars`` set anew.

    What is left of a character that a cut divides goes too; documents of which nothing but
    white space is left are dropped, those that nothing was cut from stay as they are.
    """
    scheme = repeats.Scheme(window, max(1, window * 2 // 5), False)
    return repeats.cut_text(docs, repeats.repeated(docs, scheme, _resolve), scheme, _kept)
