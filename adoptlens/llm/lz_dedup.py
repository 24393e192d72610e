"""Operator 2, substring dedup by relative Lempel-Ziv parsing.

Every document is parsed into factors, copies of runs of words of documents with smaller ids.
The texts that may repeat meet in reference blocks, whose windows are indexed by hash, the
smallest document first; every window of a document that the index holds comes back with the
document and the place it was found at (``repeats``, ``sources``). The document is then parsed
from left to right: a factor follows its reference for as long as the next window was found
right behind the last one, however many blocks it crosses; where it ends, the window at the
boundary begins a factor with its own reference, so a longer stretch that no single document
holds is covered too. Factors have ``window`` words at least, and the union of the factors is
what is removed. Of several holders of a window the smallest is taken: which one is followed
does not change the union.

Words are runs of bytes without white space. Null text has no words and keeps none; empty
tables give no rows; repeated rows and rows that share an id are not each other's reference.
Windows that meet in differing surroundings are compared word code by word code, others by two
independent 64-bit hashes. See ``repeats`` for null ids and for how texts meet.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from adoptlens.llm import repeats
from adoptlens.llm.hashing import gram_hash


def references(held: np.ndarray, first: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """For each window of a block its place in the smallest document's part, or -1 if that is its own."""
    found = np.full(len(held), -1, np.int64)
    n = len(held) - window + 1
    if n <= 0:
        return found
    at = np.arange(n)
    part = np.searchsorted(first, at, side="right") - 1
    at = at[at + window <= first[part + 1]]
    part = np.searchsorted(first, at, side="right") - 1
    index = gram_hash(held, window)[at]
    order = np.lexsort((at, doc[part], index))
    fresh = np.append(True, index[order][1:] != index[order][:-1])[: len(order)]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    source = np.empty(len(order), np.int64)
    source[order] = at[order][head]
    smaller = doc[part] > doc[np.searchsorted(first, source, side="right") - 1]
    for j in range(window):
        smaller &= held[at + j] == held[source + j]
    found[at[smaller]] = source[smaller]
    return found


def _kept(raw: bytes, gone: np.ndarray, bounds) -> bytes:
    begin, end = bounds
    rest = np.flatnonzero(~gone)
    return b" ".join([raw[a:b] for a, b in zip(begin[rest].tolist(), end[rest].tolist())])


def dedup(docs: DataFrame, window: int = 13, keep_text: bool = False) -> DataFrame:
    """``docs`` with words, removed words, spans in words, the digest of the kept words, and the
    factors (start, end, reference document, start there) whose union the spans are."""
    scheme = repeats.Scheme(window, max(1, window * 2 // 5), True, sources=True)
    return repeats.apply(docs, repeats.repeated(docs, scheme, references), scheme, _kept, keep_text)
