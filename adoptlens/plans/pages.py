"""Any page at any depth: a sorted copy of the events in ranges, and a directory of their sizes.

The copy is range-partitioned by a page order (which leaves no ties) into folders of about
``RANGE_ROWS`` rows. The directory holds the rows before each range, so an offset names the one
or two ranges its page lies in; only they are read and sorted. With filters the ranges' sizes
are counted anew (an aggregate that moves one row per range), and again only the page's ranges
are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from adoptlens.operators.filters import SEARCH_COLUMNS, USAGE_DIMS, Filters
from adoptlens.plans.dashboard import PAGE_COLUMNS, SORT_KEYS

RANGE_ROWS = 1 << 20


def _order(sort_key: str, ascending: bool) -> list[Column]:
    col = SORT_KEYS.get(sort_key, "utc_time")
    return [F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col), F.asc("usage_id")]


def write_ranked(usage: DataFrame, path: str, sort_key: str = "utc_time", ascending: bool = False, range_rows: int = RANGE_ROWS) -> None:
    """The sorted copy (with what filters read) and its directory, below ``path``."""
    spark, base = usage.sparkSession, path.rstrip("/")
    wanted = dict.fromkeys([*PAGE_COLUMNS, "usage_id", *SEARCH_COLUMNS, *USAGE_DIMS.values(), "usage_date"])
    rows = usage.select(*[c for c in wanted if c in usage.columns])
    ranges = max(1, -(-rows.count() // range_rows))
    order = _order(sort_key, ascending)
    dealt = rows.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id())
    dealt.sortWithinPartitions("part", *order).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(f"{base}/rows")
    schema = StructType([*rows.schema.fields, StructField("part", IntegerType())])
    sizes = spark.read.schema(schema).parquet(f"{base}/rows").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    _with_before(sizes).write.mode("overwrite").parquet(f"{base}/directory")


def _with_before(sizes: DataFrame) -> DataFrame:
    """(part, n, before): one row per range, so one window sees no more than the ranges."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def _directory(spark: SparkSession, path: str, filters: Filters) -> DataFrame:
    base = path.rstrip("/")
    if filters.is_empty():
        return spark.read.parquet(f"{base}/directory")
    return _with_before(filters.apply(spark.read.parquet(f"{base}/rows")).groupBy("part").agg(F.count(F.lit(1)).alias("n")))


def total(spark: SparkSession, path: str, filters: Filters | None = None) -> int:
    return _directory(spark, path, filters or Filters()).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def ranked_page(spark: SparkSession, path: str, filters: Filters | None = None, sort_key: str = "utc_time", ascending: bool = False,
                page: int = 1, page_size: int = 20) -> DataFrame:
    """Page ``page`` of a copy written with the same ``sort_key`` and ``ascending``; rows as in ``dashboard.usage_page``."""
    f, base = filters or Filters(), path.rstrip("/")
    first = max(page - 1, 0) * page_size
    near = _directory(spark, path, f).where((F.col("before") < first + page_size) & (F.col("before") + F.col("n") > first))
    parts = sorted((r.before, r.part) for r in near.collect())  # the ranges of one page
    rows = f.apply(spark.read.parquet(f"{base}/rows")).where(F.col("part").isin([p for _, p in parts]))
    rows = rows.orderBy(*_order(sort_key, ascending)).select(*PAGE_COLUMNS, "usage_id")
    skip = first - parts[0][0] if parts else 0
    return (rows.offset(skip) if skip else rows).limit(page_size)
