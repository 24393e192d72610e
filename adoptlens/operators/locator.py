"""Where a table's keys lie, without reading the table: hashed keys and their partition.

The locator of a versioned table is a list of runs, each smaller than half the one before (a
new run takes in those it outgrows, so every entry is rewritten a logarithmic number of times).
A run is a table (hash, part) in folders by hash bucket, sorted by hash, with a Bloom filter
per bucket, kept as rows of Spark bitmaps; all places of a key lie in one bitmap, so a batch
meets the filters with one row per key. It is held against them first; only the buckets that may
hold one of its keys are read.

Entries are never wrong by omission: a key that moved keeps its old entry, and keys that share
a hash have one each, so a look-up may name a partition too many. The caller compares the keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of a bucket; filter bits per key, in powers of two; places of a key in its filter.
BUCKET_KEYS, BITS_PER_KEY, PLACES = 1 << 20, 32, 3
#: Bits of one bitmap of Spark's bitmap functions.
BITMAP = 32768
#: Rows up to which a side of a join may be broadcast, at a few hundred bytes each.
SHORT = 100_000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _power(n: int) -> int:
    return 1 << max(0, (int(n) - 1).bit_length())


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(buckets)).cast("int")


def _slot(run: dict) -> Column:
    """The bitmap of its bucket's filter that holds all places of a key."""
    return F.pmod(F.xxhash64("hash", F.lit(0)), F.lit(run["slots"])).cast("int")


def _places() -> list[Column]:
    """A key's places in its bitmap."""
    return [F.pmod(F.xxhash64("hash", F.lit(i)), F.lit(BITMAP)) for i in range(1, PLACES + 1)]


def _read(spark: SparkSession, path: str, run: dict, buckets=None) -> DataFrame:
    rows = spark.read.schema("hash long, part string, bucket int").parquet(f"{path}/{run['folder']}/rows")
    return rows if buckets is None else rows.where(F.col("bucket").isin(sorted(buckets)))


def add(spark: SparkSession, path: str, number: int, entries: DataFrame, runs: list[dict]) -> tuple[list[dict], list[str]]:
    """Runs with ``entries`` (hash, part) added, and the folders of those it took in.

    ``entries`` are read several times, so they should be stored.
    """
    n = entries.count()
    if not n:
        return runs, []
    path, runs, old = path.rstrip("/"), list(runs), []
    while runs and runs[-1]["n"] <= 2 * n:
        old.append(runs.pop())
        n += old[-1]["n"]
    buckets = _power(-(-n // BUCKET_KEYS))
    run = {"folder": f"_locator/run={number}", "n": n, "buckets": buckets, "slots": _power(-(-BITS_PER_KEY * n // buckets // BITMAP))}
    parts = [entries.select("hash", "part"), *[_read(spark, path, r).select("hash", "part") for r in old]]
    rows = reduce(DataFrame.union, parts).withColumn("bucket", _bucket(buckets))
    rows = rows.repartition("bucket")
    rows = rows.distinct() if old else rows  # within the buckets, without another shuffle
    target = f"{path}/{run['folder']}"
    rows.sortWithinPartitions("bucket", "hash").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{target}/rows")
    at = _read(spark, path, run).select("bucket", _slot(run).alias("slot"), F.explode(F.array(*_places())).alias("bit"))
    at.groupBy("bucket", "slot").agg(F.bitmap_construct_agg("bit").alias("bitmap")).write.mode("overwrite").parquet(f"{target}/filter")
    return [*runs, run], [r["folder"] for r in old]


def short(df: DataFrame, n: int) -> DataFrame:
    """``df`` of ``n`` rows as a join's side: the planner may broadcast it only if it has few rows.

    Its guess is the size of a file's compressed columns, often a tenth of the rows in memory.
    """
    return df if n <= SHORT else df.hint("merge")


def _maybe(spark: SparkSession, path: str, run: dict, keys: DataFrame) -> DataFrame:
    """(folder, bucket) of the keys that the run's filters do not rule out."""
    folder = F.lit(run["folder"]).alias("folder")
    if "slots" not in run:  # its filter was written with places in several bitmaps
        return spark.range(run["buckets"]).select(folder, F.col("id").cast("int").alias("bucket"))
    filters = spark.read.schema("bucket int, slot int, bitmap binary").parquet(f"{path}/{run['folder']}/filter")

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1

    # the keys grow with the batch; a task holds its share of the filters
    mine = (F.col("bucket") == _bucket(run["buckets"])) & (F.col("slot") == _slot(run))
    told = keys.join(filters.hint("shuffle_hash"), mine)
    return told.where(reduce(Column.__and__, [is_set(p) for p in _places()])).select(folder, "bucket")


def find(spark: SparkSession, path: str, keys: DataFrame, runs: list[dict], n: int | None = None) -> DataFrame:
    """(hash, part): the partitions that may hold each of ``keys`` (hash; ``n`` rows, if known), from the buckets that the filters leave."""
    path, found = path.rstrip("/"), []
    if runs:
        left = reduce(DataFrame.union, [_maybe(spark, path, r, keys) for r in runs]).distinct().collect()  # at most every bucket once
        for run in runs:
            buckets = {r.bucket for r in left if r.folder == run["folder"]}
            if buckets:
                found.append(_read(spark, path, run, buckets).select("hash", "part"))
    if not found:
        return spark.createDataFrame([], "hash long, part string")
    asked = short(keys.select("hash").distinct(), keys.count() if n is None else n)
    return reduce(DataFrame.union, found).join(asked, "hash", "left_semi").distinct()
