"""Operator 4, benchmark decontamination, in DataFrame functions alone.

The benchmark's windows of ``n`` normalised words become a set keyed by hash. Every training
window is hashed and held against that set, which is broadcast after its size is checked; the
same join beyond that, shuffled, moves a row number, a place and a hash per window, never a text.
A hit counts only if the words themselves agree: texts with hits are joined to them once, and
each hit takes its own words along.

Null text has no words; an item of fewer than ``n`` words is one window, of none has no
window; an item without an id marks words but is not listed. Every row of ``docs`` is judged
by itself, repeated rows and null ids too; empty tables give empty results or clean
documents; further columns are ignored by ``hits`` and kept by ``clean``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptlens.llm.tables import stored

#: At most so many hashes of windows are broadcast, 8 bytes each; beyond it the same join is shuffled.
BROADCAST_HASHES = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII signs, A-Z in lower case; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.coalesce(F.array_remove(F.split(low, SEPARATORS), ""), F.array().cast("array<string>"))


def _windows(length: Column | int, w: Column, size: Column) -> Column:
    """Hashes of all windows of ``length`` words."""
    starts = F.when(size >= length, F.sequence(F.lit(1), size - (length - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, length)))


def grams(benchmark: DataFrame, n: int) -> DataFrame:
    """Distinct windows: hash, length, words and the ids of the items that hold them."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    w = w.withColumn("length", F.least(F.size("w"), F.lit(n))).where("length > 0")
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1))
    each = w.select("item_id", "length", "w", at.alias("at")).select("item_id", "length", F.slice("w", F.col("at"), F.col("length")).alias("gram"))
    return each.groupBy("length", "gram").agg(F.array_sort(F.collect_set("item_id")).alias("items")).withColumn("hash", F.xxhash64("gram"))


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """Per row of ``docs``: words, hit words, spans (start, end in words), items, verdict.

    ``contaminated``: at least one word in ``share`` is hit. ``text_hash`` tells rows of one
    id apart.
    """
    known = stored(grams(benchmark, n), "benchmark-windows")
    lengths = sorted(r[0] for r in known.select("length").distinct().collect())  # 1 to n at most
    seen = stored(_looked_up(docs, known, lengths), "looked-up")
    # the words of each hit, from the texts that have any
    some = seen.where(F.size("found") > 0)
    wanted = some.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("text_hash").eqNullSafe(F.col("__hash"))
    texts = _rows(docs).select("doc_id", "text_hash", "text").join(wanted, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    texts = texts.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), words(F.col("text")).alias("w"))
    told = F.transform("found", lambda h: F.struct(h["start"].alias("start"), h["length"].alias("length"), h["hash"].alias("hash"), F.slice(F.col("w"), h["start"] + 1, h["length"]).alias("gram")))
    each = some.join(texts, same).select("row", F.explode(told).alias("h")).select("row", "h.*")
    true_hits = each.join(known.select("hash", "gram", "items"), ["hash", "gram"])
    by_row = true_hits.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("windows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    rows = seen.select("row", "doc_id", "text_hash", "n_words").join(by_row, "row", "left")
    out = rows.withColumns({"spans": F.aggregate(F.coalesce("windows", no_spans), no_spans, _joined), "items": F.coalesce("items", F.array().cast("array<string>"))})
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]))
    out = out.withColumns({"n_hit": n_hit, "n_words": F.col("n_words").cast("long")})
    verdict = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return out.select("doc_id", "text_hash", "n_words", "n_hit", "spans", "items", verdict.alias("contaminated"))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _looked_up(docs: DataFrame, known: DataFrame, lengths: list[int]) -> DataFrame:
    """(row, doc_id, text_hash, n_words, found): per row the windows (start, length, hash) that share a benchmark window's hash."""
    rows = _rows(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash", words(F.col("text")).alias("w")).withColumn("n_words", F.size("w"))
    none = F.array(F.lit(None).cast("long"))  # a last element, so that every document goes on
    every = F.concat(*[_windows(k, F.col("w"), F.col("n_words")) for k in lengths], none)
    looked = rows.withColumn("hashes", every).select("row", "doc_id", "text_hash", "n_words", F.posexplode_outer("hashes").alias("at", "hash"))
    # the hashes of the k-th length follow those of the lengths before it
    begins, total = [], F.lit(0)
    for k in lengths:
        begins.append(total)
        total = total + F.greatest(F.lit(0), F.col("n_words") - (k - 1))
    start, length = F.col("at"), F.lit(0)
    for k, begin in zip(lengths, begins):
        start = F.when(F.col("at") >= begin, F.col("at") - begin).otherwise(start)
        length = F.when(F.col("at") >= begin, F.lit(k)).otherwise(length)
    hashes = known.select("hash", F.lit(True).alias("known")).distinct()
    hashes = F.broadcast(hashes) if known.count() <= BROADCAST_HASHES else hashes
    found = looked.join(hashes, "hash", "left").where("known or hash is null")
    hit = F.when(F.col("known"), F.struct(start.alias("start"), length.alias("length"), "hash"))
    return found.groupBy("row", "doc_id", "text_hash", "n_words").agg(F.collect_list(hit).alias("found"))


def _joined(done: Column, new: Column) -> Column:
    """Spans so far with one more window, which starts no earlier than the others."""
    meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= new["start"])
    end = F.greatest(F.try_element_at(done, F.lit(-1))["end"], new["end"])
    begin = F.try_element_at(done, F.lit(-1))["start"]
    rest = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    longer = F.concat(rest, F.array(F.struct(begin.alias("start"), end.alias("end"))))
    return F.when(meets, longer).otherwise(F.concat(done, F.array(F.struct(new["start"].alias("start"), new["end"].alias("end")))))


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = hits(docs, benchmark, n, share).where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("bad_id")) & F.xxhash64("text").eqNullSafe(F.col("bad_hash"))
    return docs.join(bad, same, "left_anti")
