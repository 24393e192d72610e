"""SparkSession construction and cluster-level settings.

The engine never hard-codes a scratch location: lineage is cut by tables written into the
shared folder named by ``spark.checkpoint.dir``. A local default is set only when a local
session has none (tests, laptops). Tables written inside a ``scratch_scope`` go when it ends.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps in the data mean UTC; local calendars are
# derived explicitly with convert_timezone, so the session zone is pinned to UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast decisions stay with the planner: a side is broadcast only when its
    # statistics (static) or its materialised shuffle size (AQE, exact) is under these
    # bounds; beyond them the join stays a shuffled sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "adoptlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's base configuration."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_settings(input_bytes: int, target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input.

    AQE coalesces small shuffle partitions after each stage, so the initial number only has
    to be large enough that no partition of the largest shuffle exceeds the target size
    (spill-free sorts and aggregations); it is derived from the input volume.
    """
    n = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session whose master is ``local`` (tests, laptops) may do without the setting and
    gets a folder of its own; anywhere else each executor would write to its own disk, so a
    missing setting raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="adoptlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes, at its end, every intermediate table that was started inside it.

    A report's sections read such tables lazily, so write or collect them before the end.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table the engine wrote itself (staging copies), best effort."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - cleanup must never fail the job
        pass


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``; a table that cannot be read is no reason to say no."""
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a file with ``text`` at ``path`` by renaming a finished one over it."""
    import uuid

    jvm = spark.sparkContext._jvm
    new = f"{path}.{uuid.uuid4().hex[:8]}"
    p, _ = _file_system(spark, new)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    _, fs = _file_system(spark, new)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(p, jvm.org.apache.hadoop.fs.Path(path), options)
