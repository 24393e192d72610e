"""Exact distinct users over any window without raw rows: bitmaps of dense user numbers.

Every user has a number, given once. A cell is a (local day, report dimensions) with the bitmap
of its users, in blocks of 32,768 numbers, and its events; a window or a filter is the OR of its
cells' bitmaps. Stored as three tables below one path:

* ``users``: (user, no), only ever appended to;
* ``events``: cells of the events, by their own attributes (versioned, by day);
* ``activity``: cells of the events of people on the roster, by the roster's attributes and
  access state (versioned, by day); ``people``: those of the roster itself.

``refresh`` rewrites the cells of touched days only. After a change of the roster call it
without ``touched``, since all days' ``activity`` carries the roster's attributes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from adoptlens.functions.access import GRANTED, PENDING, RESIGNED, REVOKED
from adoptlens.functions.numeric import pct, ratio
from adoptlens.operators import versions
from adoptlens.operators.filters import ROSTER_DIMS, USAGE_DIMS, Filters, non_blank
from adoptlens.operators.ranking import numbered
from adoptlens.plans.rollup import rows
from adoptlens.session import path_exists

EVENT_DIMS = list(USAGE_DIMS.values())
PEOPLE_DIMS = [*ROSTER_DIMS.values(), "access_state"]
USERS = "user string, no long"


def _numbers(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """The stored numbers, with those of new ``names`` (user) appended."""
    target = f"{path}/users"
    new, top = names, 0
    if path_exists(spark, target):
        known = spark.read.schema(USERS).parquet(target)
        new, top = names.join(known, "user", "left_anti"), known.agg(F.max("no")).first()[0] or 0
    given = numbered(new, [F.col("user")], "no").select("user", (F.col("no") + F.lit(top)).alias("no"))
    given.write.mode("append").parquet(target)
    return spark.read.schema(USERS).parquet(target)


def _cells(counted: DataFrame, dims: Sequence[str], events: Column | None) -> DataFrame:
    """Rows with ``no`` to one row per ``dims`` and block of numbers."""
    aggs = [F.bitmap_construct_agg(F.bitmap_bit_position("no")).alias("bitmap")]
    if events is not None:
        aggs.append(events.alias("events"))
    return counted.groupBy(*dims, F.bitmap_bucket_number("no").alias("block")).agg(*aggs)


def _touched(df: DataFrame, touched) -> DataFrame:
    if touched is None:
        return df
    dates = [d for d in touched if d is not None]
    day = F.col("usage_date")
    some = F.coalesce(day.isin(dates), F.lit(False)) if dates else F.lit(False)
    return df.where(some | day.isNull() if len(dates) < len(touched) else some)


def _store(spark: SparkSession, path: str, cells: DataFrame, touched) -> None:
    """Replace the cells of the touched days (all without ``touched``) in one version."""
    before = versions.current(spark, path)
    schema = StructType([*[f for f in cells.schema.fields if f.name != "usage_date"], StructField("usage_date", cells.schema["usage_date"].dataType)])
    number = before.number + 1 if before else 1
    written = versions.write_partitions(cells.select(*schema.names).hint("rebalance", "usage_date"), path, number, "usage_date")
    old = before.folders if before else {}
    gone = set(old) if touched is None else {versions.as_text(d) for d in touched}
    folders = {**{d: f for d, f in old.items() if d not in gone}, **written}
    retired = before.retired if before else []
    versions.publish(spark, path, versions.Version(number, schema, "usage_date", folders, retired=retired), [f for d, f in old.items() if d in gone])


def refresh(spark: SparkSession, usage: DataFrame, roster: DataFrame, path: str, touched: list | None = None) -> None:
    """Bring the stored bitmaps up to date, for all days or for the ``touched`` ones (None among them: events without a day)."""
    path = path.rstrip("/")
    some = _touched(usage, touched)
    # events of one user, day and set of attributes are one row before anything is joined
    counted = some.groupBy("usage_date", "user_email", *EVENT_DIMS).agg(rows(some).alias("n"))
    names = counted.select(F.col("user_email").alias("user")).union(roster.select("email")).where("user is not null").distinct()
    numbers = _numbers(spark, path, names)
    by_user = counted.join(numbers, F.col("user_email") == F.col("user"), "left")
    _store(spark, f"{path}/events", _cells(by_user, ["usage_date", *EVENT_DIMS], F.sum("n")), touched)
    people = roster.select(*PEOPLE_DIMS, F.col("email").alias("user")).join(numbers, "user")
    _cells(people, PEOPLE_DIMS, None).write.mode("overwrite").parquet(f"{path}/people")
    daily = counted.groupBy("usage_date", F.col("user_email").alias("user")).agg(F.sum("n").alias("n"))
    _store(spark, f"{path}/activity", _cells(daily.join(people, "user"), ["usage_date", *PEOPLE_DIMS], F.sum("n")), touched)


def _users(cells: DataFrame, name: str, keep: Column = None) -> DataFrame:
    """One row: how many users the OR of the (kept) cells' bitmaps has."""
    cells = cells if keep is None else cells.where(keep)
    blocks = cells.groupBy("block").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("users"))
    return blocks.agg(F.coalesce(F.sum("users"), F.lit(0)).alias(name))


def _window(f: Filters) -> Column:
    dates = Filters(start_date=f.start_date, end_date=f.end_date)
    out = F.lit(True)
    for p in dates.predicates(None, {}, instant_col=None):
        out = out & p
    return F.coalesce(out, F.lit(False))


def _supported(f: Filters) -> None:
    if f.products or f.search:
        raise ValueError("bitmaps know no tools and no searched text")


def dashboard_kpis(spark: SparkSession, path: str, filters: Filters | None = None) -> DataFrame:
    """``dashboard.kpis`` of any window and any selection of report dimensions."""
    f = filters or Filters()
    _supported(f)
    cells = f.apply(versions.read_table(spark, f"{path.rstrip('/')}/events"))
    sums = cells.agg(F.coalesce(F.sum("events"), F.lit(0)).cast("bigint").alias("total_actions"),
                     F.count_distinct(F.when(non_blank("practice"), F.col("practice"))).alias("practice_areas"))
    return _users(cells, "active_users").crossJoin(sums)  # one row x one row


def adoption_kpis(spark: SparkSession, path: str, filters: Filters | None = None) -> DataFrame:
    """``adoption.adoption_kpis`` of any window and any selection of roster dimensions."""
    f, base = filters or Filters(), path.rstrip("/")
    _supported(f)
    chosen = f.without("dates", "accesses")
    people = chosen.apply(spark.read.parquet(f"{base}/people"), ROSTER_DIMS)
    cells = chosen.apply(versions.read_table(spark, f"{base}/activity"), ROSTER_DIMS).where(F.col("access_state") == GRANTED)
    # people are on the roster once, so their blocks' counts add up
    n = F.bitmap_count("bitmap")
    state = F.col("access_state")
    out = people.agg(*[F.coalesce(F.sum(F.when(test, n)), F.lit(0)).alias(name) for name, test in {
        "total_workforce": state.isin(GRANTED, PENDING), "access_granted": state == GRANTED, "access_pending": state == PENDING,
        "revoked_count": state == REVOKED, "resigned_count": state == RESIGNED}.items()])
    inside = cells.where(_window(f))
    actions = inside.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("actions"))
    for one in (_users(inside, "active_users"), _users(cells, "ever"), actions):
        out = out.crossJoin(one)  # one row x one row
    return out.select(
        "total_workforce", "access_granted", "access_pending", "active_users", (F.col("access_granted") - F.col("active_users")).alias("inactive_users"),
        "revoked_count", "resigned_count", (F.col("access_granted") - F.col("ever")).alias("never_used_lifetime"),
        pct(F.col("active_users"), F.col("access_granted")).alias("adoption_rate"), ratio(F.col("actions"), F.col("active_users")).alias("avg_actions_per_active"))
