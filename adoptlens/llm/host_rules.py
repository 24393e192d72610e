"""Operator 12, host-level quality rules, in DataFrame functions alone.

Every document is measured by itself and judged by the base rules. Failures are counted per
host; as a host of few documents says little by its bare rate, rates are shrunk towards all
hosts' mean with a beta prior whose two parameters are estimated from the hosts themselves
(moments, without what sampling adds to their spread). A host whose shrunk rate is above
``most`` fails, and its verdict is joined back to its documents.

The window of ``SPAN`` words that repeats is found without a shuffle: hashes of a text's windows
are sorted within its row, and what shares a hash is compared as text.

Null text has no words; a document without a host is judged by the base rules alone; every row
is judged by itself, repeated rows and null ids too, and counts once for its host; an empty
table gives no rows; further columns are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptlens.llm.tables import stored

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]+"
#: Words of a window; words that a document has at least; share of repeated words in a hundred.
SPAN, LEAST_WORDS, MOST_REPEATED = 3, 50, 50
#: Bits of a window's place in its text, which holds below 2^30 words; the rest is hash.
PLACE_BITS = 30
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _shared(sorted_: str, key: Callable[[Column], Column]) -> Column:
    """Of a sorted array: the elements whose key a neighbour shares."""

    def shares(x: Column, i: Column) -> Column:
        own, before, after = key(x), F.get(F.col(sorted_), i - 1), F.get(F.col(sorted_), i + 1)
        return F.coalesce(key(before) == own, F.lit(False)) | F.coalesce(key(after) == own, F.lit(False))

    return F.filter(sorted_, shares)


def _window(words: str, at: Column) -> list[Column]:
    return [F.get(F.col(words), at + k) for k in range(SPAN)]


def measured(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, text_hash, host, measures) of every row.

    Steps that a later expression reads more than once stay columns of their own, so that none
    is worked out again for each element. Windows are sorted as single integers, hash above
    place.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col(host).cast("string").alias("host"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    rows = rows.withColumns({"words": F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""), "lines": lines})
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.octet_length("text") - F.octet_length(F.regexp_replace("text", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "codes": F.transform("words", lambda w: F.xxhash64(w)),
    }).drop("text", "lines")
    starts = F.when(F.size("words") >= SPAN, F.sequence(F.lit(0), F.size("words") - SPAN)).otherwise(F.array().cast("array<int>"))
    packed = F.transform(starts, lambda i: F.shiftleft(F.xxhash64(*_window("codes", i)), PLACE_BITS).bitwiseOR(i.cast("long")))
    rows = rows.withColumn("packed", F.sort_array(packed)).drop("codes")
    # the few whose hash is shared are compared as text
    place = _shared("packed", lambda x: F.shiftright(x, PLACE_BITS))
    told = F.transform(place, lambda x: _told(x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")))
    rows = rows.withColumn("told", F.sort_array(told)).drop("words", "packed")
    rows = rows.withColumn("at", F.sort_array(F.transform(_shared("told", lambda x: x["key"]), lambda x: x["at"])))
    # each repeated window covers its words up to where the next one begins
    own = F.transform("at", lambda x, i: F.least(F.lit(SPAN), F.coalesce(F.get(F.col("at"), i + 1) - x, F.lit(SPAN))))
    rows = rows.withColumn("n_repeat_words", F.aggregate(own, F.lit(0).cast("long"), lambda total, x: total + x))
    return rows.select("doc_id", "text_hash", "host", *MEASURES)


def _told(at: Column) -> Column:
    return F.struct(F.concat_ws(" ", *_window("words", at)).alias("key"), at.alias("at"))


def base_rules() -> dict[str, Column]:
    """Rules on the measures of one document; true: it fails."""
    return {
        "too few words": F.col("n_words") < LEAST_WORDS,
        "repeated words": 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"),
    }


def prior(hosts: DataFrame) -> DataFrame:
    """One row (mean, weight): the beta prior of the hosts' failure rates, weight in documents.

    Without more spread than sampling gives, the weight is that of all documents.
    """
    exact = "decimal(38,12)"  # sums that no order of the rows changes
    rate = F.col("failed").cast("double")
    sums = hosts.agg(
        F.count("*").alias("k"), F.sum("n").alias("total"), F.sum("failed").alias("bad"),
        F.sum((rate * rate / F.col("n")).cast(exact)).cast("double").alias("squares"),
        F.sum((F.lit(1.0) / F.col("n")).cast(exact)).cast("double").alias("inverse"),
    ).withColumn("mean", F.col("bad") / F.col("total"))
    spread = F.col("k") * (F.col("squares") - F.col("bad") * F.col("mean")) / ((F.col("k") - 1) * F.col("total"))
    sums = sums.withColumns({"spread": F.when(F.col("k") > 1, spread), "single": F.col("mean") * (1 - F.col("mean"))})
    between = F.col("spread") - F.col("single") * F.col("inverse") / F.col("k")
    weight = F.when(between > 0, (F.col("single") - F.col("spread")) / between).otherwise(F.col("total"))
    return sums.select("mean", F.greatest(F.lit(1.0), F.least(weight, F.col("total"))).alias("weight"))


def host_rates(rows: DataFrame, most: float = 0.5) -> DataFrame:
    """Per host: documents, failures, shrunk rate and whether it fails."""
    hosts = rows.where("host is not null").groupBy("host").agg(F.count("*").alias("n"), F.count_if("base_failed").alias("failed"))
    hosts = stored(hosts, "hosts")
    shrunk = (F.col("failed") + F.col("mean") * F.col("weight")) / (F.col("n") + F.col("weight"))
    # the prior is one row
    rated = hosts.crossJoin(F.broadcast(prior(hosts))).withColumn("rate", F.round(shrunk, 9))
    return rated.select("host", "n", "failed", "rate", (F.col("rate") > most).alias("host_failed"))


def judge(docs: DataFrame, host: str = "source", most: float = 0.5, rules: Callable[[], dict[str, Column]] = base_rules) -> DataFrame:
    """(doc_id, text_hash, host, measures, reasons, base_failed, host_rate, host_failed, kept) of every row."""
    found = F.array_compact(F.array(*[F.when(fails, F.lit(name)) for name, fails in rules().items()]))
    rows = measured(docs, host).withColumn("reasons", found).withColumn("base_failed", F.size("reasons") > 0)
    rows = stored(rows, "measures")
    hosts = host_rates(rows, most).select("host", F.col("rate").alias("host_rate"), "host_failed")
    rows = rows.join(hosts, "host", "left").withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def keep(docs: DataFrame, host: str = "source", most: float = 0.5) -> DataFrame:
    """``docs`` without those that fail or whose host fails."""
    bad = judge(docs, host, most).where("not kept").select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash"), F.col("host").alias("__bad_host")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__bad_id")) & F.xxhash64("text").eqNullSafe(F.col("__bad_hash")) & F.col(host).cast("string").eqNullSafe(F.col("__bad_host"))
    return docs.join(bad, same, "left_anti")
