"""Row numbers over a whole table without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from adoptlens.session import scratch_path


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its 1-based position by ``order`` (which must leave no ties).

    Rows are range-partitioned by the order, stored once in the shared folder, numbered
    within their partition and shifted by the sizes of the partitions before; only those
    sizes, one per partition, meet in one window.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    held = spark.read.schema(StructType([*df.schema.fields, StructField("__part", IntegerType())])).parquet(path)
    sizes = held.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (held.withColumn("__n", within).join(F.broadcast(offsets), "__part")  # one row per partition
            .withColumn(name, (F.col("__n") + F.col("__before")).cast("bigint")).drop("__part", "__n", "__before"))
