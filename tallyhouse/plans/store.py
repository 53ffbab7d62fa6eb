"""Written tables. Every table that others read is stored once and read back."""

import atexit
import tempfile
import threading
import time
import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# Readers skip folders and files whose names begin with this.
DONE = "_SUCCESS"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session.

    Only a local session, whose executors live in one process, gets a temporary
    folder when none is named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tallyhouse-")


class Files:
    """The few file operations a store needs, on whatever file system its root is."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def names(self, path: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        system, where = self._at(path)
        if not system.exists(where):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(where))

    def delete(self, path: str) -> None:
        system, where = self._at(path)
        system.delete(where, True)

    def signature(self, path: str) -> tuple:
        """Name, size and time of every file below a folder."""
        system, where = self._at(path)
        found = system.listFiles(where, True)
        out = []
        while found.hasNext():
            status = found.next()
            out.append(
                (status.getPath().toString(), status.getLen(), status.getModificationTime())
            )
        return tuple(sorted(out))


class Store:
    """Parquet tables under one root, grouped in layers.

    Every write goes to a folder of its own and counts once it is complete, so a
    table can be read while it is replaced, a failed write leaves the old one, and
    planning a query twice never touches files of the first plan. Reading a stored
    table back cuts the lineage at durable files, and gives Spark the real size of
    the table, by which it decides what to broadcast.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)
        self._current: dict[tuple[str, str], str] = {}
        self._open = threading.local()

    @classmethod
    def scratch(cls, spark: SparkSession) -> "Store":
        """A store of a session's own, removed when the process ends."""
        store = cls(spark, f"{shared_folder(spark)}/tallyhouse/{uuid.uuid4().hex}")
        atexit.register(store.close)
        return store

    def path(self, layer: str, name: str) -> str:
        """Folder of the newest complete version of a table."""
        if (layer, name) not in self._current:
            base = f"{self.root}/{layer}/{name}"
            versions = [
                v for v in self.files.names(base) if self.files.exists(f"{base}/{v}/{DONE}")
            ]
            if not versions:
                return base
            self._current[layer, name] = f"{base}/{versions[-1]}"
        return self._current[layer, name]

    def _write(self, df: DataFrame, folder: str) -> DataFrame:
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def save(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Replace a table and return it as read from storage."""
        version = f"{self.root}/{layer}/{name}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        stored = self._write(df, version)
        self._current[layer, name] = version
        return stored

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Store an intermediate result and return it as read from storage."""
        folder = f"{self.root}/work/_parts/{name}-{uuid.uuid4().hex}"
        stored = self._write(df, folder)
        for parts in getattr(self._open, "parts", [])[-1:]:
            parts.append(folder)
        return stored

    @contextmanager
    def temporary(self) -> Iterator[None]:
        """Drop what this thread keeps inside the block once the block is left."""
        stack = self._open.__dict__.setdefault("parts", [])
        stack.append([])
        try:
            yield
        finally:
            for folder in stack.pop():
                self.files.delete(folder)

    def publish(self, layer: str, name: str, df: DataFrame) -> None:
        """Make a stored table visible to SQL as layer.name."""
        self._clear(layer, name)
        self.spark.catalog.createTable(
            f"{layer}.{name}", path=self.path(layer, name), source="parquet", schema=df.schema
        )

    def _clear(self, layer: str, name: str) -> None:
        """Make room for a table or view of that name."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        # Dropping one kind fails where the name belongs to the other.
        held = [t for t in self.spark.catalog.listTables(layer) if t.name == name and not t.isTemporary]
        for table in held:
            kind = "VIEW" if table.tableType == "VIEW" else "TABLE"
            self.spark.sql(f"DROP {kind} IF EXISTS {layer}.{name}")

    def publish_keyed(self, layer: str, name: str, offsets: str, key: str, columns: list[str]) -> None:
        """Make a fact whose keys are places in its files visible to SQL as layer.name."""
        self._clear(layer, name)
        listed = ", ".join(f"f.{c}" for c in columns)
        self.spark.sql(
            f"CREATE VIEW {layer}.{name} AS"
            f" SELECT /*+ BROADCAST(o) */ o._offset + f._index + 1 AS {key}, {listed}"
            f" FROM (SELECT *, _metadata.file_name AS _file, _metadata.row_index AS _index"
            f" FROM parquet.`{self.path(layer, name)}`) f"
            f" JOIN parquet.`{self.path('work', offsets)}` o ON f._file = o._file"
        )

    def prune(self, layers: Mapping[str, Collection[str]], published: bool) -> None:
        """Leave, of each layer, the given tables in their newest version only."""
        for layer, names in layers.items():
            for name in self.files.names(f"{self.root}/{layer}"):
                base = f"{self.root}/{layer}/{name}"
                if name not in names:
                    self.files.delete(base)
                    continue
                newest = self.path(layer, name)
                for version in self.files.names(base):
                    if f"{base}/{version}" != newest:
                        self.files.delete(f"{base}/{version}")
            if published and self.spark.catalog.databaseExists(layer):
                for table in self.spark.catalog.listTables(layer):
                    if table.name not in names and not table.isTemporary:
                        self._clear(layer, table.name)

    def close(self) -> None:
        """Remove everything below the root."""
        try:
            self.files.delete(self.root)
        except (Py4JError, OSError):
            pass  # the JVM is gone already
