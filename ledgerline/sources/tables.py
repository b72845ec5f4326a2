"""Parquet tables in which every change is one commit.

A change writes its files to a folder of its own, ``{path}/_commit=7``, and then a manifest that
lists, for every partition, the folders that hold it now. Moving the manifest to its final name is
the commit: readers follow the newest one, so they see all of a change or nothing of it, also
when the driver is lost in between. A partitioned change only rewrites the partitions it touches;
the others stay where they are. Files of the version before are kept for plans that still read
them; older ones, and those of changes that were never committed, go with the next commit.

A table has one writer at a time; a second one fails on the name of its manifest. A plain Parquet
folder can be read as a table and becomes one of commits when it is first written to.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.merge import latest, put
from ledgerline.session import own_scratch, write_out

COMMIT = "_commit"
MANIFESTS = "_manifests"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Paths:
    """The three zones below one base folder."""

    base: str

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def registry(self) -> str:
        return f"{self.raw}/_state/processed_files"

    @property
    def feed(self) -> str:
        return f"{self.raw}/_state/changes"

    @property
    def statuses(self) -> str:
        return f"{self.raw}/_state/document_status"

    def curated(self, name: str) -> str:
        return f"{self.base}/curated/{name}"

    def analytics(self, name: str) -> str:
        return f"{self.base}/analytics/{name}"


@dataclass(frozen=True)
class Manifest:
    """What a version of a table consists of: partition folder (empty without partitions) ->
    numbers of the commits that hold its files."""

    version: int
    schema: T.StructType
    folders: dict[str, list[int]] = field(default_factory=dict)

    def commits(self) -> set[int]:
        return {c for commits in self.folders.values() for c in commits}


def _hadoop(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    system, location = _hadoop(spark, path)
    return system.exists(location)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none for a missing folder."""
    system, location = _hadoop(spark, path)
    return [s.getPath().getName() for s in system.listStatus(location)] if system.exists(location) else []


def _remove(spark: SparkSession, path: str) -> None:
    system, location = _hadoop(spark, path)
    system.delete(location, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    system, location = _hadoop(spark, source)
    if not system.rename(location, _hadoop(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json") and not n.startswith((".", "_")))


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """One version, by default the newest; None for a plain folder or no table."""
    if version is None:
        versions = _versions(spark, path)
        if not versions:
            return None
        version = versions[-1]
    system, location = _hadoop(spark, f"{path}/{MANIFESTS}/{version:020d}.json")
    stream = system.open(location)
    try:
        content = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(version, T.StructType.fromJson(content["schema"]), content["folders"])


def _commit(spark: SparkSession, path: str, manifest: Manifest, before: Manifest | None) -> None:
    """Make ``manifest`` the newest version, then remove what neither it nor the one before holds."""
    target = f"{path}/{MANIFESTS}/{manifest.version:020d}.json"
    if path_exists(spark, target):
        raise OSError(f"another writer has committed {target}")
    aside = f"{path}/{MANIFESTS}/_next"
    system, location = _hadoop(spark, aside)
    out = system.create(location, True)
    out.write(bytearray(json.dumps({"schema": manifest.schema.jsonValue(), "folders": manifest.folders}).encode()))
    out.close()
    _rename(spark, aside, target)
    kept = manifest.commits() | (before.commits() if before else set())
    for name in _names(spark, path):
        if name != MANIFESTS and not (name.startswith(f"{COMMIT}=") and int(name.partition("=")[2]) in kept):
            if before is not None or name.startswith(f"{COMMIT}="):
                _remove(spark, f"{path}/{name}")
    for version in _versions(spark, path)[:-2]:
        _remove(spark, f"{path}/{MANIFESTS}/{version:020d}.json")


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(_versions(spark, path)) or any(not n.startswith(("_", ".")) for n in _names(spark, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as its newest version holds it; a missing path is an error, never an empty table."""
    manifest = _manifest(spark, path)
    return spark.read.parquet(path) if manifest is None else _read(spark, path, manifest, list(manifest.folders))


def _read(spark: SparkSession, path: str, manifest: Manifest, folders: Sequence[str]) -> DataFrame:
    """The rows of some partition folders. Their paths go to the scan, so no other is listed."""
    paths = [f"{path}/{COMMIT}={c}/{f}".rstrip("/") for f in folders for c in manifest.folders.get(f, [])]
    if not paths:
        return spark.createDataFrame([], manifest.schema)
    # Without the folder of the commit in the schema, Spark would add it as a column of its own.
    rows = spark.read.schema(T.StructType([*manifest.schema.fields, T.StructField(COMMIT, T.LongType())]))
    return rows.option("basePath", path).parquet(*paths).select(*manifest.schema.names)


def _stage(spark: SparkSession, path: str, version: int, rows: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """Write the files of a commit; returns its partition folders."""
    folder = f"{path}/{COMMIT}={version}"
    _gathered(rows, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
    if not partition_by:
        return [""]
    return [n for n in _names(spark, folder) if "=" in n]


def _gathered(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, so that it gets few files. The rebalance
    splits a large partition over several tasks and joins small ones."""
    return rows.hint("rebalance", *partition_by) if partition_by else rows


def _change(
    spark: SparkSession, path: str, rows: DataFrame, partition_by: Sequence[str], kept: dict[str, list[int]],
    before: Manifest | None, check: Callable[[], None] | None = None, add: bool = False,
) -> int:
    """Write ``rows``, let ``check`` object, and commit them in the place of what their partitions
    held (or with ``add`` beside it) and beside the other ``kept`` folders."""
    version = before.version + 1 if before else 1
    folders = dict(kept)
    for name in _stage(spark, path, version, rows, partition_by):
        folders[name] = [*(folders.get(name, []) if add else []), version]
    if check:
        check()
    manifest = Manifest(version, rows.schema, folders)
    _commit(spark, path, manifest, before)
    return _read(spark, path, manifest, list(folders)).count()


def _folder_names(values: DataFrame, column: str) -> set[str]:
    """The partition folders of the values; there are as many as folders."""
    escape = values.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    found = values.select(F.col(column).cast("string")).distinct().collect()
    return {f"{column}={NO_VALUE if r[0] in (None, '') else escape(r[0])}" for r in found}


def overwrite(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = (),
    partition_by: Sequence[str] = (), check: Callable[[], None] | None = None,
) -> int:
    """Replace the whole table, one row per key; an empty frame empties the table. ``check`` runs
    when the rows are written and before they are committed; if it raises, the table is as before."""
    if keys:
        rows = latest(rows, keys, order).drop(*order)
    return _change(spark, path, rows, partition_by, {}, _manifest(spark, path), check)


def append(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """Add rows to a table without partitions; returns how many commits its files are spread over."""
    before = _manifest(spark, path)
    _change(spark, path, rows, [], before.folders if before else {}, before, add=True)
    return len(before.folders.get("", [])) + 1 if before else 1


def upsert(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
    partition_by: str | None = None, check: Callable[[], None] | None = None,
) -> int:
    """Insert or replace rows by key; returns the row count of the table, 0 for no input.

    The partition column must follow from the key, so that a key never changes partition.
    """
    split = [partition_by] if partition_by else []
    with own_scratch(spark):
        batch = write_out(latest(rows, keys, order).drop(*order))
        if batch.isEmpty():
            return 0
        before = _manifest(spark, path)
        if before is None:
            merged = put(read_table(spark, path), batch, keys) if table_exists(spark, path) else batch
            return _change(spark, path, merged, split, {}, None, check)
        touched = _folder_names(batch, partition_by) if partition_by else {""}
        kept = {f: c for f, c in before.folders.items() if f not in touched}
        existing = _read(spark, path, before, [f for f in before.folders if f in touched])
        return _change(spark, path, put(existing, batch, keys), split, kept, before, check)


def replace_partitions(
    spark: SparkSession, path: str, rows: DataFrame, partition_by: str, values: DataFrame,
    check: Callable[[], None] | None = None,
) -> int:
    """Make the partitions listed in ``values`` hold exactly ``rows``; one for which no row is left
    disappears."""
    before = _manifest(spark, path)
    if before is None:
        return overwrite(spark, path, rows, partition_by=[partition_by], check=check)
    gone = _folder_names(values, partition_by)
    kept = {f: c for f, c in before.folders.items() if f not in gone}
    return _change(spark, path, rows, [partition_by], kept, before, check)
