"""De-duplication, merge and upsert queries (lineitem by order line; roster by e-mail)."""

from __future__ import annotations

from pyspark.sql import functions as F

from adoptlens.catalog import register
from adoptlens.functions.access import access_state
from adoptlens.functions.text import clean_text
from adoptlens.operators import dedupe as DD
from adoptlens.operators import roster as R
from adoptlens.operators.upsert import read_table, upsert_into_table
from adoptlens.session import scratch_path
from adoptlens.sources import fixtures as fx
from adoptlens.sources.tables import table

W = fx.with_fixtures

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
REST = ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
           "l_returnflag, l_linestatus, l_shipdate")


def _rank_sql(direction: str, nulls: str, prefix: str = "") -> str:
    return ", ".join(f"{c} {direction} NULLS {nulls}" for c in [*ORDER, *REST]) if not prefix else \
        prefix + ", " + ", ".join(f"{c} {direction} NULLS {nulls}" for c in [*ORDER, *REST])


def _li(spark, sf):
    return table(spark, sf, "lineitem")


@register("dedupe_last", f"""
SELECT {LI_COLS} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_rank_sql('DESC', 'LAST')}) = 1""")
def q_dedupe_last(spark, sf):
    return DD.keep_last(_li(spark, sf), KEYS, ORDER)


@register("dedupe_first", f"""
SELECT {LI_COLS} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_rank_sql('ASC', 'FIRST')}) = 1""")
def q_dedupe_first(spark, sf):
    return DD.keep_first(_li(spark, sf), KEYS, ORDER)


MERGED_SQL = f"""
SELECT {LI_COLS} FROM (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN 0 ELSE 1 END AS batch FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY {_rank_sql('DESC', 'LAST', 'batch DESC')}) = 1"""


def _split(spark, sf):
    li = _li(spark, sf)
    return li.filter(F.col("l_partkey") % 2 == 0), li.filter(F.col("l_partkey") % 2 != 0)


@register("merge_extract", MERGED_SQL)
def q_merge_extract(spark, sf):
    existing, new = _split(spark, sf)
    return DD.merge_extract(existing, new, KEYS, ORDER, "l_shipdate")


@register("upsert_usage", MERGED_SQL)
def q_upsert_usage(spark, sf):
    """Base rows loaded into a month-partitioned table, then the batch upserted into it."""
    base, batch = _split(spark, sf)
    month = F.date_format("l_shipdate", "yyyy-MM")
    path = scratch_path(spark, "upsert-lineitem")
    upsert_into_table(spark, path, base.withColumn("ship_month", month), KEYS, ORDER, "ship_month")
    upsert_into_table(spark, path, batch.withColumn("ship_month", month), KEYS, ORDER, "ship_month")
    return read_table(spark, path).drop("ship_month")


ROSTER_COLS = "email, workforce_name, location, practice, team, designation, raw_status, access_state"
_FIELDS = ["workforce_name", "location", "practice", "team", "designation", "raw_status"]
_FOLD = ",\n  ".join(
    f"arg_min({f}, prec) FILTER (WHERE {f} IS NOT NULL AND {f} <> '') AS {f}" for f in _FIELDS)


@register("roster_merge", W(f"""
WITH ranked AS (
  SELECT *, CASE access_state WHEN 'granted' THEN 4 WHEN 'revoked' THEN 3 WHEN 'resigned' THEN 2
                              WHEN 'pending' THEN 1 ELSE 0 END AS rnk
  FROM roster_copies
),
w AS (
  SELECT *, rnk > COALESCE(MAX(rnk) OVER (PARTITION BY email ORDER BY src_ord
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS is_record
  FROM ranked
),
p AS (SELECT *, CASE WHEN is_record THEN -src_ord - 1 ELSE src_ord END AS prec FROM w)
SELECT email,
  {_FOLD},
  arg_min(access_state, prec) AS access_state
FROM p GROUP BY email""", usage_needed=False, extra=(fx.COPIES_SQL,)))
def q_roster_merge(spark, sf):
    return R.merge_duplicates(fx.roster_with_copies(spark, sf), "src_ord")


@register("roster_duplicates", W("""
SELECT email, COUNT(*) AS copies FROM roster_copies GROUP BY email HAVING COUNT(*) > 1""",
                                  usage_needed=False, extra=(fx.COPIES_SQL,)))
def q_roster_duplicates(spark, sf):
    return R.duplicate_emails(fx.roster_with_copies(spark, sf))


_CLEAN = ", ".join(f"NULLIF(trim({f}), '') AS {f}" for f in _FIELDS)


@register("upsert_roster", W(f"""
WITH all_rows AS (
  SELECT email, {_CLEAN}, access_state, 0 AS batch, src_ord FROM roster_copies WHERE src_ord % 2 = 0
  UNION ALL
  SELECT email, {_CLEAN}, access_state, 1 AS batch, src_ord FROM roster_copies WHERE src_ord % 2 = 1
)
SELECT {ROSTER_COLS} FROM all_rows
QUALIFY row_number() OVER (PARTITION BY email ORDER BY batch DESC) = 1""", usage_needed=False, extra=(fx.COPIES_SQL,)))
def q_upsert_roster(spark, sf):
    rows = fx.roster_with_copies(spark, sf)
    cleaned = rows.select("email", *[clean_text(f).alias(f) for f in _FIELDS], "src_ord")
    cleaned = cleaned.withColumn("access_state", access_state("raw_status"))
    stored = cleaned.filter(F.col("src_ord") % 2 == 0).drop("src_ord")
    incoming = R.merge_duplicates(cleaned.filter(F.col("src_ord") % 2 == 1), "src_ord")
    return R.upsert(stored, incoming).select(*[c.strip() for c in ROSTER_COLS.split(",")])
