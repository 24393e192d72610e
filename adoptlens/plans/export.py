"""Text exports: detail lines and leaderboard lines (CSV text without quoting).

Lines are built column-side with ``concat_ws``; the header is a one-row frame unioned in.
A distributed writer (``write_lines``) emits them as text files; no export passes through
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.functions.text import csv_safe
from adoptlens.operators.filters import Filters
from adoptlens.operators.ranking import numbered
from adoptlens.plans.dashboard import top_users

# Header texts.
USAGE_HEADER = ("utc_time,user_email,workforce_name,practice_function,location,access_point,"
                "product_surface_area,file_count,action,usage_date")
TOP_USERS_HEADER = "Rank,User Email,Workforce Name,Designation,Location,Actions,Files"


def _opt(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def usage_lines(usage: DataFrame, filters: Filters | None = None, ordered: bool = False) -> DataFrame:
    """(sort_key, line): header (0) and one detail line (1) per event.

    ``ordered``: with the event's time and id, by which ``write_lines`` sorts.
    """
    df = (filters or Filters()).apply(usage)
    line = F.concat_ws(
        ",",
        F.coalesce(F.date_format("utc_time", "yyyy-MM-dd HH:mm:ss"), F.lit("")),
        F.coalesce(F.col("user_email"), F.lit("")),
        csv_safe("workforce_name"),
        csv_safe("practice"),
        csv_safe("location"),
        F.coalesce(F.col("access_point"), F.lit("")),
        csv_safe("product_area"),
        F.coalesce(F.col("file_count").cast("string"), F.lit("0")),
        F.coalesce(_opt(df, "action"), F.lit("")),
        F.coalesce(F.date_format("usage_date", "yyyy-MM-dd"), F.lit("")),
    )
    order = ["utc_time", "usage_id"] if ordered else []
    rows = df.select(F.lit(1).alias("sort_key"), line.alias("line"), *order)
    header = df.sparkSession.range(1).select(F.lit(0).alias("sort_key"), F.lit(USAGE_HEADER).alias("line"))
    return header.unionByName(rows, allowMissingColumns=True)


def top_user_lines(usage: DataFrame, filters: Filters | None = None, k: int | None = None) -> DataFrame:
    """(rank_val, line): header (0), then a ranked line per user, or the first ``k`` users."""
    top = top_users((filters or Filters()).apply(usage), k)
    ranked = numbered(top, [F.desc("actions"), F.asc("user")], "rank_val")
    line = F.concat_ws(
        ",",
        F.col("rank_val").cast("string"),
        F.coalesce(F.col("user"), F.lit("")),
        csv_safe("name"),
        csv_safe("designation"),
        csv_safe("location"),
        F.col("actions").cast("string"),
        F.col("files").cast("string"),
    )
    rows = ranked.select(F.col("rank_val").cast("bigint").alias("rank_val"), line.alias("line"))
    header = usage.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("rank_val"),
                                                F.lit(TOP_USERS_HEADER).alias("line"))
    return header.unionByName(rows)


def lines_as_text(lines: DataFrame, order_col: str) -> DataFrame:
    """Ordered text of a top-k export in one row; everything else is written by ``write_lines``."""
    return lines.agg(F.expr(f"listagg(line, '\\n') WITHIN GROUP (ORDER BY {order_col}, line)").alias("csv_text"))


def document_lines(sections: dict[str, DataFrame], order: dict[str, list[str]] | None = None) -> DataFrame:
    """(section, number, line): a JSON document {section: [rows...]} of any length, a line per row.

    ``line`` in (section, number) order is the document: an opening line per section, its rows
    in ``order`` (then by their other columns), and a closing line. Rows are numbered over range
    partitions, so no task sees a whole section.
    """
    order, spark, out = order or {}, next(iter(sections.values())).sparkSession, None
    for k, (name, df) in enumerate(sections.items()):
        by = [*order.get(name, []), *[c for c in df.columns if c not in order.get(name, [])]]
        rows = numbered(df, [F.asc_nulls_last(c) for c in by], "__number")
        row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        lines = rows.select(F.lit(k).alias("section"), F.col("__number").alias("number"),
                            F.concat(F.when(F.col("__number") > 1, ",").otherwise(""), row).alias("line"))
        opening = ("{" if k == 0 else "],") + f'"{name}":['
        opened = spark.range(1).select(F.lit(k).alias("section"), F.lit(0).cast("long").alias("number"), F.lit(opening).alias("line"))
        lines = opened.unionByName(lines)
        out = lines if out is None else out.unionByName(lines)
    end = spark.range(1).select(F.lit(len(sections)).alias("section"), F.lit(0).cast("long").alias("number"), F.lit("]}").alias("line"))
    return out.unionByName(end)


def write_document(sections: dict[str, DataFrame], path: str, order: dict[str, list[str]] | None = None) -> None:
    """The document of ``document_lines`` as text files ``section=<k>/part-*``: end to end, in the
    order of their names, they are the document; a section's folder holds its rows alone."""
    lines = document_lines(sections, order)
    dealt = lines.repartitionByRange("section", "number").sortWithinPartitions("section", "number").select("section", "line")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("section").text(path)


def read_document(spark, path: str, names: list[str]) -> DataFrame:
    """(section, row): the rows of a written document as JSON texts, with their section's name."""
    lines = spark.read.schema("line string, section int").text(path)
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("section") + 1)
    rows = lines.where((F.col("section") < len(names)) & ~F.col("line").rlike('^(\\{|\\],)?"[^"]*":\\[$'))
    return rows.select(named.alias("section"), F.regexp_replace("line", "^,", "").alias("row"))


def write_lines(lines: DataFrame, path: str, order: list[str]) -> None:
    """Write export lines as text part files in order, header first, by a range-partitioned sort."""
    lines.orderBy(*[F.asc_nulls_first(c) if c == "sort_key" else F.asc_nulls_last(c) for c in order]).select("line").write.mode("overwrite").text(path)
