"""Folders whose content is replaced at once: every write is a new version, and a pointer names the one that counts.

A version is written whole before the pointer moves, and the pointer is a small file that a rename replaces. So a writer that
dies leaves the old version readable, and a table may be written over the one it was read from.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


class Folder:
    """A versioned folder, through the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        root = self._path(self.path)
        self._files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.makeQualified(root).toUri(), spark._jsc.hadoopConfiguration())

    def current(self) -> str | None:
        """The name of the version that counts, or None."""
        at = self._path(f"{self.path}/{POINTER}")
        if not self._files.exists(at):
            return None
        return self.spark.read.text(str(at)).first()[0]

    def number(self) -> int:
        """The number of the version that counts, -1 without one."""
        name = self.current()
        return -1 if name is None else int(name.split("-")[1])

    def latest(self) -> str:
        """Where the version that counts lies; an error without one."""
        name = self.current()
        if name is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return f"{self.path}/{name}"

    def replace(self, write: Callable[[str], None], number: int | None = None) -> str:
        """A new version, which `write` makes at the path it is given; then the pointer moves to it. Returns the version's path."""
        name = f"version-{self.number() + 1 if number is None else number:012d}-{uuid.uuid4().hex}"
        write(f"{self.path}/{name}")
        fresh = self._path(f"{self.path}/.{POINTER}-{uuid.uuid4().hex}")
        out = self._files.create(fresh, True)
        out.write(bytearray(name.encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self._context.rename(fresh, self._path(f"{self.path}/{POINTER}"), options)
        return f"{self.path}/{name}"

    def drop_old(self, keep: int = 1) -> None:
        """Deletes the versions up to the one that counts, those of writers that died included, but for it and the `keep` newest others. Not while others may read them."""
        now = self.current()
        if now is None:
            return
        number = lambda name: int(name.split("-")[1])
        names = sorted(s.getPath().getName() for s in self._files.listStatus(self._path(self.path)) if s.getPath().getName().startswith("version-"))
        for name in [n for n in names if n != now and number(n) <= number(now)][: -keep or None]:
            self._files.delete(self._path(f"{self.path}/{name}"), True)


def replace_json(df: DataFrame, path: str, *by: str) -> str:
    """df as JSON under path, by folders of columns, in place of what is there."""
    return Folder(df.sparkSession, path).replace(lambda at: df.write.partitionBy(*by).json(at))


def upsert(rows: DataFrame, path: str, key: list[str], number: int | None = None) -> None:
    """The Parquet table at path with rows in place of those of the same key, which may hold nulls. rows: a key once.

    With a number, a version of that number or a later one already there means that rows are part of it: nothing is done.
    """
    folder = Folder(rows.sparkSession, path)
    had = folder.current()
    if number is not None and folder.number() >= number:
        return
    merged = rows
    if had is not None:
        old = rows.sparkSession.read.parquet(folder.latest())
        new = rows.select(*[rows[k].alias(f"_new_{k}") for k in key])
        same = [old[k].eqNullSafe(new[f"_new_{k}"]) for k in key]
        merged = old.join(new, same, "left_anti").unionByName(rows, allowMissingColumns=True)
    folder.replace(lambda at: merged.write.parquet(at), number)
