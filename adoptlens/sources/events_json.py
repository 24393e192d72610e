"""Raw event documents ({"events": [...]}) and CSV extracts with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from adoptlens.functions.calendar import DEFAULT_TZ, local_date, local_hour, parse_utc_text
from adoptlens.sources.csv_split import read_quoted_csv

# The raw event fields, in payload order.
EVENT_FIELDS = [
    "utc_time", "user", "unique_usage_id", "access_point", "action", "product_surface_area",
    "workflow_name", "source", "subsurface", "cm_id", "parent_thread_id", "space_name",
    "playbook_name", "vault_project_name", "review_table_name",
]
EVENT_SCHEMA = StructType([StructField(f, StringType()) for f in EVENT_FIELDS]
                          + [StructField("file_ids", ArrayType(StringType()))])
DOCUMENT_SCHEMA = StructType([StructField("events", ArrayType(EVENT_SCHEMA))])


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Event documents -> one row per event (missing fields are NULL)."""
    docs = spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", multi_line).json(path)
    return docs.select(F.inline(F.coalesce(F.col("events"), F.array().cast(ArrayType(EVENT_SCHEMA)))))


def read_documents_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streaming twin of ``read_documents`` (new files in a landing folder)."""
    docs = spark.readStream.schema(DOCUMENT_SCHEMA).option("multiLine", True).json(path)
    return docs.select(F.inline(F.coalesce(F.col("events"), F.array().cast(ArrayType(EVENT_SCHEMA)))))


def file_stats(df: DataFrame, col: str = "file_ids") -> DataFrame:
    """Nested id list -> count (NULL list counts 0) and ';'-joined text."""
    return df.select(
        *[c for c in df.columns if c != col],
        F.when(F.col(col).isNull(), F.lit(0)).otherwise(F.size(col)).cast("int").alias("file_count"),
        F.array_join(col, ";").alias("file_ids_text"),
    )


def flatten(events: DataFrame, tz: str = DEFAULT_TZ, keep_file_ids: bool = True) -> DataFrame:
    """Raw event rows -> extract rows: parsed UTC time, local date/hour, file count/text.

    An unparsable time gives NULL date and hour (the reference writes blanks).
    """
    ts = parse_utc_text("utc_time")
    cols = [
        ts.alias("utc_time"),
        local_date(ts, tz).alias("usage_date"),
        local_hour(ts, tz).alias("usage_hour"),
        *[F.col(f) for f in EVENT_FIELDS if f != "utc_time"],
        # explicit NULL guard: size(NULL) is -1 when ANSI mode is off
        F.when(F.col("file_ids").isNull(), F.lit(0)).otherwise(F.size("file_ids")).cast("int").alias("file_count"),
    ]
    if keep_file_ids:
        cols.append(F.array_join("file_ids", ";").alias("file_ids"))
    return events.select(*cols)


def to_usage_events(flat: DataFrame) -> DataFrame:
    """Extract column names -> engine names (usage_id, product_area); file ids dropped."""
    return flat.withColumnRenamed("unique_usage_id", "usage_id").withColumnRenamed(
        "product_surface_area", "product_area").drop("file_ids")


def read_ordered_csv(spark: SparkSession, path: str, ord_col: str = "src_ord", multi_line: bool = True) -> DataFrame:
    """``read_extract_csv`` with the rows' order over the file set: file name, split, then row.

    With ``multi_line`` cells may hold line breaks; the files are split all the same.
    """
    if multi_line:
        return read_quoted_csv(spark, path, ord_col)
    order = F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("split"), F.monotonically_increasing_id().alias("row"))
    return read_extract_csv(spark, path, multi_line=multi_line).withColumn(ord_col, order)


def write_extract_csv(df: DataFrame, path: str) -> None:
    """CSV part files with header and RFC 4180 quoting, in the order ``df`` has."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_extract_csv(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = True) -> DataFrame:
    """UTF-8 CSV extract with header (a BOM on the first header cell is dropped by Spark);
    header names are trimmed; without a schema every column is read as text. Quoting is that of
    RFC 4180: a quoted cell may hold commas, doubled quotes and line breaks, so a file is one
    split. ``multi_line`` False is for files without line breaks inside cells, which are split."""
    reader = (spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"'))
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    return df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])
