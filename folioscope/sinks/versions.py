"""Tables whose rows are replaced by switching a pointer, never in place.

A table is a folder with one sub-folder per version and a small pointer file that
names the current one.  A replacement writes a new version next to the current
one and then renames a finished pointer over the old one, which is one atomic
step of the file system.  Whatever ends a run before that step leaves the old
rows current; what it had written is removed by the next replacement.

The version before the current one stays until the next replacement, so readers
that had begun on it can finish, and a plan may replace the table it reads.  One
writer at a time is assumed.  A folder without a pointer is a table as it is.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Spark skips names that begin with an underscore.
POINTER = "_current"
SCHEMA = "_schema"
VERSION = re.compile(r"version-(\d+)")


class Folder:
    """A folder on any file system Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.path.getFileSystem(self.conf)

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self) -> list[str]:
        if not self.files.exists(self.path):
            return []
        return [status.getPath().getName() for status in self.files.listStatus(self.path)]

    def read_text(self, name: str) -> str:
        stream = self.files.open(self.child(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        """Put a whole file in place in one step, over an earlier one if there is one."""
        passing = self.child(f"{name}.{uuid.uuid4().hex}")
        stream = self.files.create(passing, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        fs = self.jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self.files.getUri(), self.conf)
        over = self.gateway.new_array(getattr(fs, "Options$Rename"), 1)
        over[0] = getattr(fs, "Options$Rename").OVERWRITE
        context.rename(self.files.makeQualified(passing), self.files.makeQualified(self.child(name)), over)

    def rename(self, name: str, new: str) -> None:
        if not self.files.rename(self.child(name), self.child(new)):
            raise OSError(f"{self.path}/{name} could not be renamed to {new}")

    def remove(self, name: str) -> None:
        self.files.delete(self.child(name), True)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder name of the version readers get, if the table has any."""
    folder = Folder(spark, path)
    return folder.read_text(POINTER) if POINTER in folder.names() else None


def current_path(spark: SparkSession, path: str) -> str:
    """Where the table's rows are: its current version, or the folder itself."""
    version = current_version(spark, path)
    return f"{path.rstrip('/')}/{version}" if version else path


def begin_version(spark: SparkSession, path: str) -> str:
    """The name of a new version; all but the current one go, half-written ones included."""
    folder = Folder(spark, path)
    current = current_version(spark, path)
    known = {name: int(found[1]) for name in folder.names() if (found := VERSION.fullmatch(name))}
    for name in known.keys() - {current}:
        folder.remove(name)
    for name in folder.names():
        if name.startswith(f"{POINTER}.") or name.startswith(f".{POINTER}."):
            folder.remove(name)
    return f"version-{max(known.values(), default=0) + 1}"


def switch_version(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the one readers get."""
    Folder(spark, path).write_text(POINTER, version)
