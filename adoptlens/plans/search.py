"""Substring search over six columns by a dictionary, instead of LIKE on every event.

The distinct values of each searched column form a dictionary, kept with the trigrams of each
value as postings in folders by trigram. A needle is held against the dictionary alone: by the
postings of its trigrams, or by the values themselves if it has no three characters in a row.
What is left is checked with LIKE, so wildcards and escapes mean what they do in a live search.
Events are then found by the matching values: as a list in a predicate on the column, which
reaches the Parquet reader, or by a join where a column has more than ``LISTED`` of them.

Values are only ever added; ``refresh`` reads the touched days only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.text import like_needle
from adoptlens.operators.filters import SEARCH_COLUMNS
from adoptlens.session import path_exists

#: Folders of postings; matching values of a column that become a predicate.
BUCKETS, LISTED = 64, 200
VALUES = "`column` string, value string"


def _low() -> Column:
    return F.lower(F.coalesce(F.col("value"), F.lit("")))


def _trigrams(low: Column) -> Column:
    starts = F.when(F.length(low) >= 3, F.sequence(F.lit(1), F.length(low) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(3))))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def refresh(usage: DataFrame, path: str, touched: list | None = None) -> None:
    """Add the values of all events, or of those of the ``touched`` local days, to the dictionary."""
    spark, base = usage.sparkSession, path.rstrip("/")
    if touched is not None:
        days = [d for d in touched if d is not None]
        some = F.coalesce(F.col("usage_date").isin(days), F.lit(False)) if days else F.lit(False)
        usage = usage.where(some | F.col("usage_date").isNull() if len(days) < len(touched) else some)
    columns = [c for c in SEARCH_COLUMNS if c in usage.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    values = usage.select(pairs.alias("p")).select("p.column", "p.value").distinct()
    if path_exists(spark, f"{base}/values"):
        known = spark.read.schema(VALUES).parquet(f"{base}/values").select(F.col("column").alias("c"), F.col("value").alias("v"))
        values = values.join(known, (F.col("column") == F.col("c")) & F.col("value").eqNullSafe(F.col("v")), "left_anti")
    # postings first: a value counts as known only after its postings are there; repeated postings change nothing
    grams = values.select("column", "value", F.explode(_trigrams(_low())).alias("gram")).withColumn("bucket", _bucket(F.col("gram")))
    grams.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("append").partitionBy("bucket").parquet(f"{base}/postings")
    values.write.mode("append").parquet(f"{base}/values")


def literals(needle: str) -> list[str]:
    """The runs of a LIKE pattern that stand for themselves."""
    runs, at = [""], 0
    while at < len(needle):
        if needle[at] == "\\" and at + 1 < len(needle):
            runs[-1] += needle[at + 1]
            at += 1
        elif needle[at] in "%_":
            runs.append("")
        else:
            runs[-1] += needle[at]
        at += 1
    return [r for r in runs if r]


def matching(spark: SparkSession, path: str, needle: str) -> DataFrame:
    """(column, value) of the dictionary that a live search would match."""
    base, needle = path.rstrip("/"), like_needle(needle)
    grams = sorted({run[i : i + 3] for run in literals(needle) for i in range(len(run) - 2)})
    if grams:
        asked = spark.createDataFrame([(g,) for g in grams], "gram string").select(_bucket(F.col("gram")).alias("b"))
        buckets = [r.b for r in asked.distinct().collect()]
        postings = spark.read.schema(f"{VALUES}, gram string, bucket int").parquet(f"{base}/postings")
        near = postings.where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams)).groupBy("column", "value")
        found = near.agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select("column", "value")
    else:
        found = spark.read.schema(VALUES).parquet(f"{base}/values").distinct()
    return found.where(_low().like(f"%{needle}%"))


def search(usage: DataFrame, path: str, needle: str) -> DataFrame:
    """Events of which a searched column holds the needle; all of them for a blank one."""
    if not like_needle(needle):
        return usage
    spark = usage.sparkSession
    found = matching(spark, path, needle)
    counts = {r["column"]: r["count"] for r in found.groupBy("column").count().collect()}  # one row per searched column
    tests, flags = [], []
    listed = [c for c, n in counts.items() if n <= LISTED]
    values = {c: [] for c in listed}
    for r in found.where(F.col("column").isin(listed)).collect() if listed else []:  # at most LISTED per column
        values[r["column"]].append(r["value"])
    for c, own in values.items():
        known = [v for v in own if v is not None]
        tests += [F.coalesce(F.col(c).isin(known), F.lit(False))] if known else []
        tests += [F.col(c).isNull()] if len(known) < len(own) else []
    for c in counts.keys() - values.keys():
        own = found.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"), F.lit(True).alias(f"_hit_{c}"))
        usage = usage.join(own, F.col(c).eqNullSafe(F.col(f"_v_{c}")), "left")
        tests.append(F.coalesce(F.col(f"_hit_{c}"), F.lit(False)))
        flags += [f"_v_{c}", f"_hit_{c}"]
    return usage.where(reduce(lambda a, b: a | b, tests, F.lit(False))).drop(*flags)
