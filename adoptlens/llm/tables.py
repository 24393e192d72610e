"""Tables between the steps of an operator: read, stored in the shared folder, read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.session import remove_path, scratch_path

#: Frees the shuffle files of a stored table's query as soon as the table is written.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for a null id where ids are compared: no id is larger.
NO_ID = (1 << 63) - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back (lineage ends there)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads; what was made of them is stored itself."""
    for table in tables:
        remove_path(table.sparkSession, table.stored_at)


def id_or_last(name: str = "doc_id") -> Column:
    """The id as long; a null id compares as larger than every other."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))
