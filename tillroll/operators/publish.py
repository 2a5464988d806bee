"""All-or-nothing publication of a load over several Parquet tables.

The reference loads its tables in one database transaction. Here a load
writes everything aside first, in a folder of its own below ``_loads`` (which
no table read lists):

    _loads/<id>/<table>/<files>                     rows to add
    _loads/<id>/<table>/<column>=<value>/<files>    partitions to replace

Then it creates one small marker file. Before the marker nothing a reader sees
has changed, and ``recover`` drops the folder; from the marker on the load is
decided, and ``recover`` (run before every load) moves whatever was not moved
yet. Moving is idempotent: a partition's folder is replaced by rename, added
files have unique names. Dimensions move before facts and their summaries, so
no fact is ever visible without its dimension rows.

One load runs at a time; readers need no lock.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import SparkSession

LOADS = "_loads"
MARKER = "_decided"


class Files:
    """The few file operations needed, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def is_folder(self, path: str) -> bool:
        return self._fs.getFileStatus(self._path(path)).isDirectory()

    def create(self, path: str) -> None:
        self._fs.create(self._path(path), False).close()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """``source`` becomes ``target``; what was there goes."""
        to = self._path(target)
        self._fs.mkdirs(to.getParent())
        self._fs.delete(to, True)
        if not self._fs.rename(self._path(source), to):
            raise OSError(f"could not move {source} to {target}")


class Load:
    """One load's staged tables."""

    def __init__(self, files: Files, load_id: str):
        self.files = files
        self.folder = f"{files.root}/{LOADS}/{load_id}"

    def path(self, table: str, partition: str | None = None) -> str:
        return f"{self.folder}/{table}" + (f"/{partition}" if partition else "")

    @property
    def decided(self) -> bool:
        return self.files.exists(f"{self.folder}/{MARKER}")

    def decide(self) -> None:
        self.files.create(f"{self.folder}/{MARKER}")

    def drop(self) -> None:
        self.files.delete(self.folder)

    def apply(self, order: list[str]) -> None:
        """Move everything staged into the tables, those in ``order`` first."""
        found = [t for t in self.files.names(self.folder) if not t.startswith("_")]
        for table in sorted(found, key=lambda t: (order.index(t) if t in order else len(order), t)):
            source, target = self.path(table), f"{self.files.root}/{table}"
            for name in self.files.names(source):
                if "=" in name or name.endswith(".parquet"):
                    self.files.move(f"{source}/{name}", f"{target}/{name}")
        self.drop()


def recover(files: Files, order: list[str]) -> int:
    """Finish decided loads and drop undecided ones; returns how many were
    finished."""
    done = 0
    for load_id in files.names(f"{files.root}/{LOADS}"):
        load = Load(files, load_id)
        if load.decided:
            load.apply(order)
            done += 1
        else:
            load.drop()
    return done


@contextlib.contextmanager
def publication(spark: SparkSession, root: str, order: list[str]):
    """A load to stage tables in; published when the block ends without an
    error, dropped otherwise."""
    files = Files(spark, root)
    recover(files, order)
    load = Load(files, uuid.uuid4().hex)
    try:
        yield load
    except BaseException:
        load.drop()
        raise
    load.decide()
    load.apply(order)
