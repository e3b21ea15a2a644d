"""Versioned tables: which loads of which tables belong together.

A warehouse folder holds one folder per table and, below it, one folder of
finished Parquet files per load.  ``_versions`` holds one small file per
version that lists every table's loads; a version comes into being by one
rename, so a reader sees all of a load, in all its tables, or nothing of it.
Folders that no version lists (of stopped loads) are never read.

Loads are listed, not rows or files, so a version stays small; ``vacuum``
removes what the newest versions do not list.  One writer at a time may change a
warehouse: a second one that started from the same version fails to publish.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .files import file_system, path_exists, remove_path

_VERSIONS = "_versions"


@dataclass(frozen=True)
class Load:
    """Finished files of one load of a table."""

    folder: str                     # below the warehouse
    rows: int
    max_id: int | None = None
    index_keys: tuple[str, ...] = ()    # columns of the membership index, if it has one
    index_buckets: int = 0
    files: int = 0


@dataclass(frozen=True)
class Snapshot:
    root: str
    version: int = 0                # 0: nothing published yet
    tables: dict[str, tuple[Load, ...]] = field(default_factory=dict)

    def folders(self, table: str) -> list[str]:
        return [f"{self.root}/{load.folder}" for load in self.tables.get(table, ())]

    def rows(self, table: str) -> int:
        return sum(load.rows for load in self.tables.get(table, ()))

    def max_id(self, table: str) -> int:
        return max((load.max_id or 0 for load in self.tables.get(table, ())), default=0)

    def read(self, spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
        folders = self.folders(table)
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)


class ConflictError(RuntimeError):
    """Another writer published a version meanwhile."""


def _name(version: int) -> str:
    return f"v{version:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    fs, folder = file_system(spark, f"{root.rstrip('/')}/{_VERSIONS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The newest version, or the one asked for."""
    root = root.rstrip("/")
    if version is None:
        version = max(versions(spark, root), default=0)
    if version == 0:
        return Snapshot(root)
    fs, path = file_system(spark, f"{root}/{_VERSIONS}/{_name(version)}")
    stream = fs.open(path)
    try:
        held = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()
    return Snapshot(root, version, {
        name: tuple(Load(**{**load, "index_keys": tuple(load["index_keys"])}) for load in loads)
        for name, loads in held["tables"].items()})


class Transaction:
    """Loads that become visible together."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.base = read_snapshot(spark, root)
        self._added: dict[str, tuple[Load, ...]] = {}
        self._replaced: set[str] = set()

    @property
    def current(self) -> Snapshot:
        """The base version with what this transaction has added."""
        tables = {n: loads for n, loads in self.base.tables.items() if n not in self._replaced}
        for name, loads in list(self._added.items()):
            tables[name] = tables.get(name, ()) + loads
        return Snapshot(self.base.root, self.base.version, tables)

    def new_folder(self, table: str) -> str:
        """A folder below the warehouse that no other load uses."""
        return f"{table}/{uuid.uuid4().hex[:16]}"

    def add(self, table: str, load: Load) -> None:
        self._added[table] = self._added.get(table, ()) + (load,)

    def replace(self, table: str, load: Load) -> None:
        """``load`` alone holds the table's rows from this version on."""
        self._replaced.add(table)
        self._added[table] = (load,)

    def commit(self) -> Snapshot:
        """Publish by one rename; without additions the base stays the newest."""
        if not self._added:
            return self.base
        new = self.current
        version = self.base.version + 1
        body = json.dumps({"tables": {name: [asdict(load) for load in loads]
                                      for name, loads in new.tables.items()}})
        folder = f"{new.root}/{_VERSIONS}"
        fs, draft = file_system(self.spark, f"{folder}/.draft-{uuid.uuid4().hex}")
        _, target = file_system(self.spark, f"{folder}/{_name(version)}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(body.encode("utf-8")))
        finally:
            stream.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise ConflictError(f"version {version} of {new.root} exists already")
        return Snapshot(new.root, version, new.tables)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove versions but the newest ``keep`` and the loads that only those
    listed, with what stopped loads left.  No writer may be active."""
    root = root.rstrip("/")
    held = versions(spark, root)
    kept = [read_snapshot(spark, root, v) for v in held[-keep:]]
    listed = {load.folder for s in kept for loads in s.tables.values() for load in loads}
    for version in held[:-keep]:
        remove_path(spark, f"{root}/{_VERSIONS}/{_name(version)}")
    removed = 0
    fs, top = file_system(spark, root)
    for table in fs.listStatus(top) if path_exists(spark, root) else []:
        name = table.getPath().getName()
        if name == _VERSIONS or not table.isDirectory():
            continue
        for load in fs.listStatus(table.getPath()):
            if f"{name}/{load.getPath().getName()}" not in listed:
                fs.delete(load.getPath(), True)
                removed += 1
    return removed
