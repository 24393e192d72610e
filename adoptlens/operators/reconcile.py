"""Row-level reconciliation of two extracts of the same events.

The reference loops over shared ids on the driver; here it is set-based: anti-joins for
ids present on one side only, an inner join + unpivot for differing fields, and one full
outer join of the de-duplicated sides for all summary counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from adoptlens.functions.text import compare_timestamp, compare_value, strip
from adoptlens.operators.dedupe import keep_first
from adoptlens.operators.locator import short
from adoptlens.session import remove_path, scratch_path

ID_COL = "unique_usage_id"
# Compared fields, in report order.
COMPARED_FIELDS = ["user", "action", "product_surface_area", "access_point", "source", "workflow_name", "utc_time"]


def clean_ids(df: DataFrame, id_col: str = ID_COL) -> DataFrame:
    """Trim the id (as text) and drop rows whose id is blank."""
    out = df.withColumn(id_col, strip(F.col(id_col).cast("string")))
    return out.filter(F.col(id_col).isNotNull() & (F.col(id_col) != ""))


def _norm(df: DataFrame, f: str):
    t = df.schema[f].dataType
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return compare_timestamp(f)
    if isinstance(t, DateType):
        return F.coalesce(F.date_format(f, "yyyy-MM-dd"), F.lit(""))
    return compare_value(f)


def shared_fields(left: DataFrame, right: DataFrame, fields: Sequence[str] = COMPARED_FIELDS) -> list[str]:
    """Compared fields present on both sides (others are skipped, as in the reference)."""
    return [f for f in fields if f in left.columns and f in right.columns]


def first_per_id(df: DataFrame, fields: Sequence[str], ord_col: str, id_col: str = ID_COL) -> DataFrame:
    """Normalised compared values of the first row per id in file order, which ``ord_col`` tells."""
    src = df.select(id_col, ord_col, *[_norm(df, f).alias(f) for f in fields])
    return keep_first(src, [id_col], [ord_col]).select(id_col, *fields)


def only_in(a: DataFrame, b: DataFrame, id_col: str = ID_COL) -> DataFrame:
    """Rows of ``a`` whose id never occurs in ``b`` (whole rows kept)."""
    return a.join(b.select(id_col).distinct(), id_col, "left_anti")


def compared(left: DataFrame, right: DataFrame, ord_col: str, fields: Sequence[str] | None = None,
             id_col: str = ID_COL) -> DataFrame:
    """(id, _l, _r): every id of either side once, with the first row's normalised values on each; NULL where it is not.

    One full outer join of the de-duplicated sides; ``field_mismatches``, ``summary`` and
    ``write_discrepancies`` all follow from it, so a job that needs several stores it.
    """
    fields = list(fields) if fields is not None else shared_fields(left, right)
    lf, rf = (first_per_id(side, fields, ord_col, id_col).select(id_col, F.struct(F.lit(1).alias("_in"), *fields).alias(name))
              for side, name in ((left, "_l"), (right, "_r")))
    return lf.join(rf, id_col, "full")


def field_mismatches(left: DataFrame, right: DataFrame, ord_col: str, fields: Sequence[str] | None = None,
                     id_col: str = ID_COL, both: DataFrame | None = None) -> DataFrame:
    """One row per (id, field) whose normalised values differ on the two sides; ``both``: their stored ``compared``."""
    fields = list(fields) if fields is not None else shared_fields(left, right)
    j = (compared(left, right, ord_col, fields, id_col) if both is None else both).where(F.col("_l").isNotNull() & F.col("_r").isNotNull())
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"_l.{f}").alias("left_value"), F.col(f"_r.{f}").alias("right_value"))
        for f in fields
    ])).alias("p")
    return j.select(F.col(id_col), pairs).select(id_col, "p.field", "p.left_value", "p.right_value").filter(
        F.col("left_value") != F.col("right_value"))


def _digests(df: DataFrame, fields: Sequence[str], id_col: str) -> DataFrame:
    """Per id hash: rows, and the least and greatest digest of a row's id and compared values."""
    values = [F.col(id_col), *[_norm(df, f) for f in fields]]
    digest = F.struct(F.xxhash64(*values).alias("a"), F.hash(*values).alias("b"))  # 96 bits
    rows = df.select(F.xxhash64(id_col).alias("_id_hash"), digest.alias("d"))
    return rows.groupBy("_id_hash").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))


def open_ids(left: DataFrame, right: DataFrame, fields: Sequence[str], id_col: str = ID_COL) -> DataFrame:
    """(_id_hash): ids on both sides that their digests do not settle: the rows differ, or there are several."""
    both = _digests(left, fields, id_col).alias("l").join(_digests(right, fields, id_col).alias("r"), "_id_hash")
    several = (F.col("l.n") > 1) | (F.col("r.n") > 1)
    settled = (F.col("l.low") == F.col("r.low")) & (F.col("l.high") == F.col("r.high"))
    alike = (F.col("l.low") == F.col("l.high")) | ~several
    return both.where(~(settled & alike)).select("_id_hash")


def field_mismatches_by_digest(left: DataFrame, right: DataFrame, ord_col: str, fields: Sequence[str] | None = None,
                               id_col: str = ID_COL) -> DataFrame:
    """``field_mismatches`` for extracts that are mostly equal.

    Only a hash and a digest per row are shuffled; whole rows move for the ids that these leave
    open. Rows that differ are taken for equal only where both their digests collide.
    """
    fields = list(fields) if fields is not None else shared_fields(left, right)
    wanted = open_ids(left, right, fields, id_col)

    def some(df: DataFrame) -> DataFrame:
        return df.withColumn("_id_hash", F.xxhash64(id_col)).join(wanted, "_id_hash", "left_semi").drop("_id_hash")

    return field_mismatches(some(left), some(right), ord_col, fields, id_col)


def summary(left: DataFrame, right: DataFrame, ord_col: str, fields: Sequence[str] | None = None,
            id_col: str = ID_COL, both: DataFrame | None = None) -> DataFrame:
    """rows, unique ids, only-left, only-right, shared, field mismatches and pass/fail.

    ``compared`` (or ``both``, where it is stored) gives every id count and the number of
    differing fields at once; both sides arrive hash-partitioned by id from their
    de-duplication, so the join adds no further exchange of the inputs.
    """
    fields = list(fields) if fields is not None else shared_fields(left, right)
    j = compared(left, right, ord_col, fields, id_col) if both is None else both
    shared = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    diffs = F.lit(0)
    for f in fields:
        diffs = diffs + F.when(shared & (F.col(f"_l.{f}") != F.col(f"_r.{f}")), 1).otherwise(0)
    ids = j.agg(
        F.count("_l").alias("left_ids"),
        F.count("_r").alias("right_ids"),
        F.count_if(F.col("_r").isNull()).alias("only_left"),
        F.count_if(F.col("_l").isNull()).alias("only_right"),
        F.count_if(shared).alias("shared"),
        F.coalesce(F.sum(diffs), F.lit(0)).cast("bigint").alias("field_mismatches"),
    )
    rows = left.agg(F.count(F.lit(1)).alias("left_rows")).crossJoin(
        right.agg(F.count(F.lit(1)).alias("right_rows")))
    out = rows.crossJoin(ids)  # one-row aggregates
    return out.withColumn(
        "passed", (F.col("only_left") == 0) & (F.col("only_right") == 0) & (F.col("field_mismatches") == 0))


def write_discrepancies(left: DataFrame, right: DataFrame, out_dir: str, ord_col: str, id_col: str = ID_COL,
                        both: DataFrame | None = None) -> dict[str, bool]:
    """Write the three discrepancy outputs, each only when it has rows (CSV with header).

    Ids are cleaned here, as for every comparison. ``both``: the stored ``compared`` of the
    cleaned sides; the ids of one side alone are then read from it.
    """
    left, right, spark = clean_ids(left, id_col), clean_ids(right, id_col), left.sparkSession

    def alone(a: DataFrame, b: DataFrame, other: str) -> DataFrame:
        if both is None:
            return only_in(a, b, id_col)
        ids = both.where(F.col(other).isNull()).select(id_col)
        return a.join(short(ids, ids.count()), id_col, "left_semi")

    outputs = {
        "only_in_left": alone(left, right, "_r").drop(ord_col),
        "only_in_right": alone(right, left, "_l").drop(ord_col),
        "field_mismatches": field_mismatches(left, right, ord_col, id_col=id_col, both=both),
    }
    written = {}
    for name, df in outputs.items():
        staged = scratch_path(spark, "discrepancies")  # found once, whether there are any and to be written
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        has_rows = not rows.isEmpty()
        if has_rows:
            rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{out_dir.rstrip('/')}/{name}")
        remove_path(spark, staged)
        written[name] = has_rows
    return written
