"""Pre-computed unfiltered report sections (the dashboard cache) and JSON documents.

``refresh`` writes every section of the unfiltered reports as its own Parquet table and a
manifest that names the tables, and then replaces a one-line pointer file: readers either see
the previous complete version or the new complete one, never a half-written mix.
``read_or_compute`` answers from the snapshot only when no filter is set and the section exists
(the reference's "cache has the expected key" check); otherwise it runs the live plan.

Between the events and the sections stand two layers that a day's change can be merged into:

* the usage rollup, a versioned table by local day;
* ``STATES``, additive counts of the whole rollup (per day, per value of a dimension, per tool,
  per person, per practice and team) from which the sections are computed.

``refresh_incremental`` re-aggregates the touched days, takes their old rows off each state and
adds the new ones, and computes only the sections whose states changed; states, sections and
days that did not change keep their files.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptlens.functions.features import tool_array
from adoptlens.operators import versions
from adoptlens.operators.filters import Filters, non_blank
from adoptlens.plans import adoption, dashboard
from adoptlens.plans.rollup import FILES, WEIGHT, usage_rollup
from adoptlens.session import path_exists, replace_text, scratch_path, scratch_scope

#: Keys of each state; ``values`` holds the raw values of every chart dimension.
STATES = {
    "days": ["usage_date"],
    "values": ["dimension", "value"],
    "tools": ["label"],
    "people": ["user_email", "workforce_name", "designation", "location", "practice"],
    "pairs": ["practice", "team"],
}
#: Written per section: charts of these dimensions.
CHARTS = ["practice", "team", "location", "designation"]
#: What each section is computed from; ``values.x``: only values of that dimension.
DEPENDS = {
    "dashboard.kpis": {"people"}, "dashboard.timeline": {"days"}, "dashboard.timeline_granularity": {"days"}, "dashboard.tools": {"tools"},
    **{f"dashboard.{c}": {f"values.{c}"} for c in CHARTS}, "top_users": {"people"},
    "filter_options": {f"values.{c}" for c in dashboard.OPTION_DIMS.values()}, "filter_options.products": {"tools"},
    "filter_options.teams_by_practice": {"pairs"}, **{f"adoption.{s}": {"people", "roster"} for s in adoption.SECTIONS},
}


def _state(name: str, rollup: DataFrame) -> DataFrame:
    """A state's keys with the events and files of the rollup's rows."""
    n, f = F.col(WEIGHT), F.coalesce(F.col(FILES), F.lit(0)).alias(FILES)
    if name == "values":
        pair = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in dashboard.CHART_DIMS])).alias("p")
        rows = rollup.select(pair, n, f).select("p.dimension", "p.value", n, FILES)
    elif name == "tools":
        rows = rollup.select(F.explode(tool_array("product_area")).alias("label"), n, f)
    else:
        rows = rollup.select(*STATES[name], n, f)
    return _summed(rows, STATES[name])


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = rows.groupBy(*keys).agg(F.sum(WEIGHT).cast("bigint").alias(WEIGHT), F.sum(FILES).cast("bigint").alias(FILES))
    return sums.where((F.col(WEIGHT) != 0) | (F.col(FILES) != 0))


def _options(values: DataFrame) -> DataFrame:
    named = reduce(lambda out, kv: out.when(F.col("dimension") == kv[1], kv[0]), dashboard.OPTION_DIMS.items(), F)
    return values.select(named.alias("dimension"), F.col("value").cast("string").alias("value")).where(F.col("dimension").isNotNull() & non_blank("value")).distinct().orderBy("dimension", "value")


def _section(name: str, states: dict[str, DataFrame]) -> DataFrame:
    """A section other than the adoption report's."""
    kind = name.removeprefix("dashboard.")
    if kind in CHARTS:
        return dashboard.count_by(states["values"].where(F.col("dimension") == kind).withColumnRenamed("value", kind), kind)
    return {
        "kpis": lambda: dashboard.kpis(states["people"]),
        "timeline": lambda: dashboard.timeline(states["days"]),
        "timeline_granularity": lambda: dashboard.timeline_granularity(states["days"]),
        "tools": lambda: dashboard.top_of_counts(states["tools"].select("label", F.col(WEIGHT).alias("value"))),
        "top_users": lambda: dashboard.top_users(states["people"]),
        "filter_options": lambda: _options(states["values"]),
        "filter_options.products": lambda: states["tools"].select(F.col("label").alias("product")).distinct().orderBy("product"),
        "filter_options.teams_by_practice": lambda: dashboard.teams_by_practice(states["pairs"]),
    }[kind]()


def _side_by_side(tasks: list[Callable], parallel_jobs: int) -> list:
    """Small, independent jobs, submitted concurrently so the cluster runs them side by side."""
    if not tasks:
        return []
    with ThreadPoolExecutor(max_workers=max(1, min(parallel_jobs, len(tasks)))) as pool:
        return list(pool.map(lambda t: t(), tasks))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _publish(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` current: the pointer, a file of one line, is replaced by a rename."""
    replace_text(spark, f"{root.rstrip('/')}/CURRENT", version)


def _new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def _roster_digest(roster: DataFrame) -> str:
    """Differs when a row of the roster does, whatever their order."""
    row = roster.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(roster.columns)).cast("decimal(38,0)"))).first()
    return f"{row[0]}:{row[1]}"


def _put_rollup(spark: SparkSession, path: str, fresh: DataFrame, touched, was: versions.Version | None = None) -> versions.Version:
    """Replace the touched days of the rollup ``was``, or all days (``touched`` None), in one version.

    A refresh that died after this step leaves a rollup that no snapshot names; the next one
    builds on the snapshot's again.
    """
    before = versions.current(spark, path)
    number = before.number + 1 if before else 1
    written = versions.write_partitions(fresh.hint("rebalance", "usage_date"), path, number, "usage_date")
    old = (was or before).folders if before else {}
    gone = set(old) if touched is None else {versions.as_text(d) for d in touched}
    schema = fresh.select(*[c for c in fresh.columns if c != "usage_date"], "usage_date").schema
    after = versions.Version(number, schema, "usage_date", {**{d: f for d, f in old.items() if d not in gone}, **written}, retired=before.retired if before else [])
    unused = (set(before.folders.values()) | set(old.values())) - set(after.folders.values()) if before else ()
    return versions.publish(spark, path, after, sorted(unused))


def _finish(spark: SparkSession, root: str, version: str, roster: DataFrame, manifest: dict, changed: set[str], parallel_jobs: int) -> str:
    """Compute the sections that depend on a changed state, then publish the version."""
    base = f"version={version}"
    states = {k: spark.read.parquet(f"{root}/{folder}") for k, folder in manifest["states"].items()}
    names = [n for n, needs in DEPENDS.items() if needs & changed or n not in manifest["sections"]]
    people = adoption.bundle(roster, states["people"]) if any(n.startswith("adoption.") for n in names) else {}

    def write(name: str):
        section = people[name.removeprefix("adoption.")] if name.startswith("adoption.") else _section(name, states)
        _write(section, f"{root}/{base}/section={name}")

    _side_by_side([lambda n=n: write(n) for n in names], parallel_jobs)
    manifest["sections"].update({n: f"{base}/section={n}" for n in names})
    replace_text(spark, f"{root}/{base}/MANIFEST", json.dumps(manifest))
    _publish(spark, root, version)
    return version


def refresh(spark: SparkSession, usage: DataFrame, roster: DataFrame, root: str,
            sections: dict[str, DataFrame] | None = None, parallel_jobs: int = 8) -> str:
    """Write a new snapshot version and make it current; returns the version id.

    The usage table is scanned once, into the rollup; states and sections come from it. Nothing
    is cached in executor memory, so a lost executor only re-runs its tasks. ``sections``: write
    these instead.
    """
    root, version = root.rstrip("/"), _new_version()
    base = f"version={version}"
    if sections is not None:
        _side_by_side([lambda n=n, df=df: _write(df, f"{root}/{base}/section={n}") for n, df in sections.items()], parallel_jobs)
        _publish(spark, root, version)
        return version
    with scratch_scope(spark):
        held = _put_rollup(spark, f"{root}/rollup", usage_rollup(usage), None)
        rollup = versions.read_folders(spark, f"{root}/rollup", held)
        _side_by_side([lambda n=n: _write(_state(n, rollup), f"{root}/{base}/state={n}") for n in STATES], parallel_jobs)
        manifest = {"rollup": held.number, "states": {n: f"{base}/state={n}" for n in STATES}, "sections": {}, "roster": _roster_digest(roster)}
        return _finish(spark, root, version, roster, manifest, set(), parallel_jobs)


def refresh_incremental(spark: SparkSession, usage: DataFrame, roster: DataFrame, root: str,
                        touched_dates: list, parallel_jobs: int = 8) -> str:
    """New snapshot version after a sync that changed only ``touched_dates`` (None: events without a day).

    Reads the touched days of the events (a partition-pruned read) and of the rollup, and the
    states; everything that does not change keeps its files. Falls back to a full refresh when
    there is no previous version to build on.
    """
    root = root.rstrip("/")
    manifest = _manifest(spark, root, current_version(spark, root))
    if manifest is None or not path_exists(spark, f"{root}/rollup/_log/{manifest['rollup']:012d}.json"):
        return refresh(spark, usage, roster, root, parallel_jobs=parallel_jobs)
    version = _new_version()
    base = f"version={version}"
    dates = [d for d in touched_dates if d is not None]
    day = F.col("usage_date")
    touched = F.coalesce(day.isin(dates), F.lit(False)) if dates else F.lit(False)
    if len(dates) < len(touched_dates):  # events without a day changed too
        touched = touched | day.isNull()
    with scratch_scope(spark):
        was = versions.current(spark, f"{root}/rollup", manifest["rollup"])
        texts = {versions.as_text(d) for d in touched_dates}
        before = versions.read_folders(spark, f"{root}/rollup", was, texts)
        held = _put_rollup(spark, f"{root}/rollup", usage_rollup(usage.filter(touched)).select(*before.columns), touched_dates, was)
        after = versions.read_folders(spark, f"{root}/rollup", held, texts)
        # the days' new rows count for, their old ones against a state
        change = after.unionByName(before.withColumns({WEIGHT: -F.col(WEIGHT), FILES: -F.col(FILES)}))
        moved = scratch_path(spark, "rollup-change")
        _write(_summed(change.withColumn(FILES, F.coalesce(F.col(FILES), F.lit(0))), [c for c in before.columns if c not in (WEIGHT, FILES)]), moved)
        change = spark.read.schema(change.select(*before.columns).schema).parquet(moved)
        deltas = {n: scratch_path(spark, f"delta-{n}") for n in STATES}

        def differs(name: str) -> set[str]:
            delta = _state(name, change)
            _write(delta, deltas[name])
            delta = spark.read.schema(delta.schema).parquet(deltas[name])
            if name == "values":
                return {f"values.{r[0]}" for r in delta.select("dimension").distinct().collect()}
            return set() if delta.isEmpty() else {name}

        changed = set().union(*_side_by_side([lambda n=n: differs(n) for n in STATES], parallel_jobs))

        def merge(name: str) -> None:
            old = spark.read.parquet(f"{root}/{manifest['states'][name]}")
            delta = spark.read.schema(old.schema).parquet(deltas[name])
            _write(_summed(old.unionByName(delta), STATES[name]), f"{root}/{base}/state={name}")

        renewed = [n for n in STATES if any(c.split(".")[0] == n for c in changed)]
        _side_by_side([lambda n=n: merge(n) for n in renewed], parallel_jobs)
        digest = _roster_digest(roster)
        changed |= {"roster"} if digest != manifest["roster"] else set()
        manifest = {"rollup": held.number, "states": {**manifest["states"], **{n: f"{base}/state={n}" for n in renewed}}, "sections": manifest["sections"], "roster": digest}
        return _finish(spark, root, version, roster, manifest, changed, parallel_jobs)


def _manifest(spark: SparkSession, root: str, version: str | None) -> dict | None:
    path = f"{root.rstrip('/')}/version={version}/MANIFEST"
    if version is None or not path_exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def current_version(spark: SparkSession, root: str) -> str | None:
    path = f"{root.rstrip('/')}/CURRENT"
    if not path_exists(spark, path):
        return None
    rows = spark.read.text(path).take(1)
    return rows[0][0] if rows else None


def read_section(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame | None:
    """A section of ``version``, by default of the current one."""
    version = version or current_version(spark, root)
    if version is None:
        return None
    manifest = _manifest(spark, root, version)
    if manifest is not None and name == "usage_rollup":
        return versions.read_table(spark, f"{root.rstrip('/')}/rollup", manifest["rollup"])
    folder = f"version={version}/section={name}" if manifest is None else manifest["sections"].get(name, "none")
    path = f"{root.rstrip('/')}/{folder}"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_sections(spark: SparkSession, root: str, names: list[str], filters: Filters | None,
                  live: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """The named sections, all of one version; ``live`` runs (once) only if one of them is not there."""
    found = {}
    if filters is None or filters.is_empty():
        version = current_version(spark, root)
        found = {n: read_section(spark, root, n, version) for n in names} if version else {}
    missing = [n for n in names if found.get(n) is None]
    computed = live() if missing else {}
    return {n: computed[n] if n in missing else found[n] for n in names}


def read_or_compute(spark: SparkSession, root: str, name: str, filters: Filters | None,
                    compute: Callable[[], DataFrame], version: str | None = None) -> DataFrame:
    """Snapshot when every filter is empty and the section exists, else the live plan.

    A caller that reads several sections resolves ``version`` once, so they belong together.
    """
    if filters is None or filters.is_empty():
        snap = read_section(spark, root, name, version)
        if snap is not None:
            return snap
    return compute()


def to_document(sections: dict[str, DataFrame], order: dict[str, list[str]] | None = None) -> DataFrame:
    """One-row JSON document {section: [rows...]} with NULL fields kept.

    Meant for small, capped sections (charts, top-k lists); rows are ordered inside each
    array by ``order[section]``.
    """
    order = order or {}
    out = None
    for name, df in sections.items():
        keys = order.get(name) or df.columns[:1]
        packed = df.select(F.struct(*[F.col(k) for k in keys]).alias("_k"), F.struct(*df.columns).alias("_v"))
        one = packed.agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_v"))),
                                     lambda s: s["_v"]).alias(name))
        out = one if out is None else out.crossJoin(one)
    return out.select(F.to_json(F.struct(*sections.keys()), {"ignoreNullFields": "false"}).alias("document"))
