"""Dashboard sections over the usage table.

Each section is a DataFrame plan; the caller applies ``Filters`` first. Large inputs are
reduced by partial (map-side) aggregation before any shuffle; every later step (top-k,
labels, the 'Other' roll-up) runs on already-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.features import tool_array
from adoptlens.operators.filters import Filters, non_blank
from adoptlens.plans.rollup import files, rows, stored_rollup, weight

# Labels for missing chart values and missing people attributes.
UNKNOWN = "Unknown"
DASH = "—"

# Tools named before 'Other', and the spans of the timeline's steps.
TOP_TOOLS = 8
DAILY_MAX_SPAN = 60
MONTHLY_MAX_SPAN = 730


def kpis(usage: DataFrame) -> DataFrame:
    """Distinct users, rows and distinct non-blank practices (one row).

    Rows are counted per (user, practice) first, so the two distinct counts work on that
    small frame and never multiply the raw rows.
    """
    pairs = usage.groupBy("user_email", "practice").agg(rows(usage).alias("n"))
    return pairs.agg(
        F.count_distinct("user_email").alias("active_users"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_actions"),
        F.count_distinct(F.when(non_blank("practice"), F.col("practice"))).alias("practice_areas"),
    )


def count_by(usage: DataFrame, col: str, limit: int | None = None, default: str = UNKNOWN) -> DataFrame:
    """Rows per dimension value (NULL -> 'Unknown'), by count desc then label.

    With ``limit`` the plan is a TakeOrderedAndProject over the partially aggregated counts.
    """
    out = usage.groupBy(F.coalesce(F.col(col), F.lit(default)).alias("label")).agg(rows(usage).alias("value"))
    out = out.orderBy(F.desc("value"), F.asc("label"))
    return out.limit(limit) if limit else out


CHART_DIMS = ["practice", "team", "location", "designation", "access_point"]


def dimension_counts(usage: DataFrame, dims: list[str] = CHART_DIMS, default: str = UNKNOWN) -> DataFrame:
    """All dimension charts from ONE scan: (dimension, label, value) via GROUPING SETS.

    Each row is expanded once per dimension inside the same stage and partially aggregated
    before the single shuffle.
    """
    cols = [F.coalesce(F.col(d), F.lit(default)).alias(d) for d in dims]
    g = usage.select(*cols, weight(usage).alias("_w")).groupingSets([[d] for d in dims], *dims).agg(
        F.sum("_w").cast("bigint").alias("value"), F.grouping_id().alias("_gid"))
    n = len(dims)
    # grouping_id bit for dimension i (0-based, leftmost = most significant) is 0 when grouped
    dim_name = F.lit(None).cast("string")
    label = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        only_d = (1 << n) - 1 - (1 << (n - 1 - i))
        dim_name = F.when(F.col("_gid") == only_d, F.lit(d)).otherwise(dim_name)
        label = F.when(F.col("_gid") == only_d, F.col(d)).otherwise(label)
    return g.select(dim_name.alias("dimension"), label.alias("label"), "value")


def charts_from_counts(counts: DataFrame, dims: list[str]) -> dict[str, DataFrame]:
    """Split one-scan dimension counts into one frame per chart."""
    return {d: counts.filter(F.col("dimension") == d).select("label", "value").orderBy(F.desc("value"), F.asc("label"))
            for d in dims}


def daily_counts(usage: DataFrame, date_col: str = "usage_date") -> DataFrame:
    """Rows per non-NULL date: the only pass over the large input a timeline needs."""
    return usage.filter(F.col(date_col).isNotNull()).groupBy(F.col(date_col).alias("day")).agg(
        rows(usage).alias("cnt")
    )


def _span_and_granularity(daily: DataFrame) -> DataFrame:
    span = daily.agg(F.coalesce(F.datediff(F.max("day"), F.min("day")), F.lit(0)).alias("day_span"))
    return span.withColumn(
        "granularity",
        F.when(F.col("day_span") <= DAILY_MAX_SPAN, "daily")
        .when(F.col("day_span") <= MONTHLY_MAX_SPAN, "monthly")
        .otherwise("yearly"),
    )


def timeline(usage: DataFrame, date_col: str = "usage_date") -> DataFrame:
    """Adaptive timeline: daily (span <= 60 d), monthly (<= 730 d) else yearly buckets.

    The large table is scanned once into per-day counts (at most one row per calendar
    day); the span and the re-bucketing run on that small frame. The one-row span is
    joined by broadcast — its size is one row by construction.
    """
    daily = daily_counts(usage, date_col)
    span = _span_and_granularity(daily)
    g = F.col("granularity")
    bucket = (
        F.when(g == "daily", F.col("day"))
        .when(g == "monthly", F.trunc("day", "month"))
        .otherwise(F.trunc("day", "year"))
    )
    out = (
        daily.crossJoin(F.broadcast(span))
        .groupBy(bucket.alias("bucket"), g.alias("granularity"))
        .agg(F.sum("cnt").alias("value"))
    )
    label = (
        F.when(g == "daily", F.date_format("bucket", "yyyy-MM-dd"))
        .when(g == "monthly", F.date_format("bucket", "MMM yyyy"))
        .otherwise(F.date_format("bucket", "yyyy"))
    )
    return out.select("bucket", label.alias("label"), F.col("value").cast("bigint").alias("value"),
                      "granularity").orderBy("bucket")


def timeline_granularity(usage: DataFrame, date_col: str = "usage_date") -> DataFrame:
    return _span_and_granularity(daily_counts(usage, date_col)).select("granularity", "day_span")


def hourly_histogram(spark: SparkSession, usage: DataFrame) -> DataFrame:
    """Legacy chart: events per local hour 0-23, zero-filled from a 24-row spine."""
    counts = usage.filter(F.col("usage_hour").isNotNull()).groupBy(F.col("usage_hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    spine = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    # at most one row per hour of the day
    return spine.join(F.broadcast(counts), "hour", "left").select(
        "hour", F.coalesce(F.col("cnt"), F.lit(0)).cast("bigint").alias("cnt")
    ).orderBy("hour")


def tools_exploded(usage: DataFrame) -> DataFrame:
    """(label, _w): one row per tool mention with the row's event multiplicity."""
    return usage.select(F.explode(tool_array("product_area")).alias("label"), weight(usage).alias("_w"))


def tool_counts(usage: DataFrame) -> DataFrame:
    """Mentions per tool (a row listing a tool twice counts twice; blanks dropped)."""
    return tools_exploded(usage).groupBy("label").agg(F.sum("_w").cast("bigint").alias("value"))


def top_tools_with_other(usage: DataFrame, k: int = TOP_TOOLS) -> DataFrame:
    """Top-k tools plus an 'Other' row with the rest (only when > 0), 'Other' last.

    ``is_other`` marks the roll-up row, so a tool literally named 'Other' stays separate.
    The top-k is a distributed TakeOrderedAndProject; the remainder is total minus top-k,
    so no single-partition window is needed whatever the number of tools.
    """
    return top_of_counts(tool_counts(usage), k)


def top_of_counts(counts: DataFrame, k: int = TOP_TOOLS) -> DataFrame:
    """``top_tools_with_other`` from the mentions (label, value) of every tool."""
    top = counts.orderBy(F.desc("value"), F.asc("label")).limit(k)
    top_sum = top.agg(F.coalesce(F.sum("value"), F.lit(0)).alias("top_sum"))
    total = counts.agg(F.coalesce(F.sum("value"), F.lit(0)).alias("total"))
    other = (
        total.crossJoin(top_sum)
        .select(F.lit("Other").alias("label"), (F.col("total") - F.col("top_sum")).alias("value"))
        .filter(F.col("value") > 0)
    )
    return (
        top.withColumn("is_other", F.lit(False))
        .unionByName(other.withColumn("is_other", F.lit(True)))
        .orderBy("is_other", F.desc("value"), "label")
    )


def top_users(usage: DataFrame, limit: int | None = None) -> DataFrame:
    """Leaderboard: per user max name/designation/location, actions, files; all users, or
    the first ``limit``.

    Two-level aggregation: first by (user, name, designation, location) — string *keys* keep
    it a hash aggregate with map-side combining over the big table — then per user over that
    small frame (usually one attribute combination per user). Taking max of each attribute
    over the combinations equals taking it over all rows.
    """
    attrs = ["workforce_name", "designation", "location"]
    combos = (
        usage.filter(F.col("user_email").isNotNull())
        .groupBy("user_email", *attrs)
        .agg(rows(usage).alias("n"), files(usage).alias("f"))
    )
    out = (
        combos.groupBy(F.col("user_email").alias("user"))
        .agg(
            F.coalesce(F.max("workforce_name"), F.lit(DASH)).alias("name"),
            F.coalesce(F.max("designation"), F.lit(DASH)).alias("designation"),
            F.coalesce(F.max("location"), F.lit(DASH)).alias("location"),
            F.sum("n").cast("bigint").alias("actions"),
            F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("files"),
        )
        .orderBy(F.desc("actions"), F.asc("user"))
    )
    return out.limit(limit) if limit else out


# The page sort allow-list (UI key -> usage column); anything else -> event time.
SORT_KEYS = {
    "user": "user_email",
    "Workforce Name": "workforce_name",
    "Practice/ Function": "practice",
    "Location": "location",
    "access_point": "access_point",
    "product_surface_area": "product_area",
    "file_count": "file_count",
}
PAGE_COLUMNS = ["utc_time", "user_email", "workforce_name", "practice", "location", "access_point",
                "product_area", "file_count"]


def usage_page(usage: DataFrame, filters: Filters | None = None, sort_key: str = "utc_time",
               ascending: bool = False, page: int = 1, page_size: int = 20,
               secondary_time_desc: bool = False) -> DataFrame:
    """One page of detail rows: allow-listed sort, NULLS LAST both ways, usage_id tie-break.

    ``offset(n).limit(m)`` after the sort plans as a top-(n+m) TakeOrderedAndProject, so a
    page never sorts the whole table into one partition; callers that walk through many
    pages use ``usage_page_after``, whose cost does not grow with depth.
    """
    df = (filters or Filters()).apply(usage)
    col = SORT_KEYS.get(sort_key, "utc_time")
    order = [F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col)]
    if secondary_time_desc and col != "utc_time":
        order.append(F.desc_nulls_last("utc_time"))
    order.append(F.asc("usage_id"))
    offset = max(page - 1, 0) * page_size
    ordered = df.orderBy(*order).select(*PAGE_COLUMNS, "usage_id")
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(page_size)


def usage_page_after(usage: DataFrame, filters: Filters | None = None, sort_key: str = "utc_time",
                     ascending: bool = False, after: tuple | None = None, page_size: int = 20) -> DataFrame:
    """Next page after a cursor ``(sort value, usage_id)`` of the previous page's last row.

    Same order as ``usage_page`` (NULLS LAST both ways, then usage_id); the filter skips
    everything up to the cursor, so any page is a top-(page_size) however deep it is.
    """
    df = (filters or Filters()).apply(usage)
    col = SORT_KEYS.get(sort_key, "utc_time")
    c, uid = F.col(col), F.col("usage_id")
    if after is not None:
        value, last_id = after
        if value is None:  # already inside the NULL tail
            df = df.filter(c.isNull() & (uid > F.lit(last_id)))
        else:
            v = F.lit(value)
            beyond = (c > v) if ascending else (c < v)
            df = df.filter(beyond | ((c == v) & (uid > F.lit(last_id))) | c.isNull())
    order = [F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col), F.asc("usage_id")]
    return df.orderBy(*order).limit(page_size).select(*PAGE_COLUMNS, "usage_id")


def usage_total(usage: DataFrame, filters: Filters | None = None) -> DataFrame:
    f = (filters or Filters()).apply(usage)
    return f.agg(rows(f).alias("total"))


# Dimensions offered as filters (document key -> usage column).
OPTION_DIMS = {"practices": "practice", "locations": "location", "accesses": "access_point",
               "designations": "designation"}


def filter_options(table: DataFrame, dims: dict[str, str] = OPTION_DIMS) -> DataFrame:
    """Sorted distinct non-blank values per dimension, long form (dimension, value).

    One scan: each row is fanned out to (dimension, value) pairs with ``stack`` and a single
    distinct aggregation runs over them.
    """
    dims = {k: v for k, v in dims.items() if v in table.columns}
    pairs = table.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(v).cast("string").alias("value"))
                            for k, v in dims.items()])).alias("p")
    ).select("p.dimension", "p.value")
    return pairs.filter(non_blank("value")).distinct().orderBy("dimension", "value")


def product_options(usage: DataFrame) -> DataFrame:
    return tools_exploded(usage).select(F.col("label").alias("product")).distinct().orderBy("product")


def teams_by_practice(table: DataFrame) -> DataFrame:
    """Hierarchy practice -> team (distinct non-blank pairs, long form)."""
    return (
        table.filter(non_blank("practice") & non_blank("team"))
        .select("practice", "team").distinct().orderBy("practice", "team")
    )


def teams_by_practice_map(table: DataFrame) -> DataFrame:
    """Document form: one row with map practice -> sorted team list."""
    grouped = teams_by_practice(table).groupBy("practice").agg(F.array_sort(F.collect_list("team")).alias("teams"))
    return grouped.agg(F.map_from_entries(F.collect_list(F.struct("practice", "teams"))).alias("teams_by_practice"))


def bundle(usage: DataFrame, filters: Filters | None = None) -> dict[str, DataFrame]:
    """All sections of the dashboard for one filter set.

    Practice and team charts use the fully filtered frame (all filters). The filtered events
    are scanned once, into a rollup that every section reads.
    """
    f = stored_rollup((filters or Filters()).apply(usage))
    return {
        "kpis": kpis(f),
        "timeline": timeline(f),
        "timeline_granularity": timeline_granularity(f),
        "practice": count_by(f, "practice"),
        "team": count_by(f, "team"),
        "location": count_by(f, "location"),
        "tools": top_tools_with_other(f),
        "designation": count_by(f, "designation"),
    }


#: Sections of ``bundle``.
SECTIONS = ("kpis", "timeline", "timeline_granularity", "practice", "team", "location", "tools", "designation")


def team_facet(usage: DataFrame, filters: Filters) -> DataFrame:
    """Legacy self-excluding facet: team counts under every filter except the team one."""
    return count_by(filters.without("teams").apply(usage), "team")
