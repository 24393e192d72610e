"""Versioned, partitioned Parquet tables: a reader sees one complete version, never half a change.

Under the table's path (all names that a plain Parquet reader skips, so that nobody reads a
mixture of versions by accident):

* ``_log/<number>.json``: a version's map from partition value to folder, its columns, the
  batches applied so far, and the writers' own marks;
* ``_data/_v=<number>/<column>=<value>/``: the partitions that version wrote.

A change writes its partitions under a new number, which no reader knows yet, and is published
by renaming its finished log file to that number. The rename fails where another writer was
first. Folders that a version no longer uses stay for ``KEEP`` further versions, for readers
that opened an older one; a writer that dies leaves folders that ``vacuum`` deletes.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adoptlens.session import _file_system, remove_path

#: Versions for which a folder stays after it is no longer used.
KEEP = 2
# Fixed value: the folder name of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentChange(RuntimeError):
    """Another writer published the version that this one was about to."""


@dataclass(frozen=True)
class Version:
    """One state of a table. ``folders``: partition value as text to folder below the path."""

    number: int
    schema: StructType
    partition_col: str
    folders: dict[str, str]
    ledger: dict[str, int] = field(default_factory=dict)
    marks: dict = field(default_factory=dict)
    runs: list[dict] = field(default_factory=list)
    retired: list[list] = field(default_factory=list)

    def text(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @staticmethod
    def of(text: str) -> "Version":
        held = json.loads(text)
        return Version(**{**held, "schema": StructType.fromJson(held["schema"])})


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _utils(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def as_text(value) -> str:
    return NULL_FOLDER if value is None else str(value)


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The newest version (or ``number``); None where there is no versioned table."""
    log = f"{path.rstrip('/')}/_log"
    numbers = [int(n[:-5]) for n in _names(spark, log) if n.endswith(".json")]
    if not numbers:
        return None
    return Version.of(spark.read.text(f"{log}/{number or max(numbers):012d}.json", wholetext=True).first()[0])


def read_folders(spark: SparkSession, path: str, version: Version, values=None) -> DataFrame:
    """The table's rows, or those of some partition values (as text), by their folders alone."""
    base = path.rstrip("/")
    folders = [f"{base}/{f}" for v, f in sorted(version.folders.items()) if values is None or v in values]
    if not folders:
        return spark.createDataFrame([], version.schema)
    rows = spark.read.schema(version.schema).option("basePath", f"{base}/_data").parquet(*folders)
    return rows.select(*version.schema.names)


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A versioned table as of now (or of version ``number``), or a plain Parquet table."""
    version = current(spark, path, number)
    return spark.read.parquet(path) if version is None else read_folders(spark, path, version)


def write_partitions(df: DataFrame, path: str, number: int, partition_col: str) -> dict[str, str]:
    """Write ``df`` under version ``number``, unseen by readers; its folders by partition value."""
    spark, below = df.sparkSession, f"_data/_v={number}"
    target = f"{path.rstrip('/')}/{below}"
    # a writer that died may have left something under this number
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(target)
    prefix = f"{partition_col}="
    names = [n for n in _names(spark, target) if n.startswith(prefix)]
    return {_utils(spark).unescapePathName(n[len(prefix):]): f"{below}/{n}" for n in names}


def _put_new(spark: SparkSession, path: str, text: str) -> None:
    """Put a file at ``path`` by renaming a finished one; raises if there is one already."""
    jvm = spark.sparkContext._jvm
    new = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    p, fs = _file_system(spark, new)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(p, jvm.org.apache.hadoop.fs.Path(path), options)
    except Exception as error:
        fs.delete(p, False)
        if "FileAlreadyExists" in str(error):
            raise ConcurrentChange(path) from error
        raise


def publish(spark: SparkSession, path: str, version: Version, unused: list[str] = ()) -> Version:
    """Make ``version`` the current one; ``unused``: folders that it no longer needs."""
    base = path.rstrip("/")
    used = set(version.folders.values())
    retired = [x for x in version.retired if x[0] not in used] + [[f, version.number] for f in unused]
    gone = [f for f, since in retired if since <= version.number - KEEP]
    version = replace(version, retired=[x for x in retired if x[1] > version.number - KEEP])
    _put_new(spark, f"{base}/_log/{version.number:012d}.json", version.text())
    for folder in gone:
        remove_path(spark, f"{base}/{folder}")
    remove_path(spark, f"{base}/_log/{version.number - KEEP - 1:012d}.json")
    return version


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete folders that neither the current version nor one kept for readers uses.

    For times without a writer, whose unpublished folders would count as unused too.
    """
    base, version = path.rstrip("/"), current(spark, path)
    used = {*version.folders.values(), *(f for f, _ in version.retired), *(r["folder"] for r in version.runs)}
    held = [f"_data/{v}/{p}" for v in _names(spark, f"{base}/_data") for p in _names(spark, f"{base}/_data/{v}") if "=" in p]
    held += [f"_locator/{r}" for r in _names(spark, f"{base}/_locator")]
    gone = [f for f in held if f not in used]
    for folder in gone:
        remove_path(spark, f"{base}/{folder}")
    return gone
