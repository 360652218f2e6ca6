"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE splits the hot partitions of a join, picks a broadcast only after it has
# measured the side, and merges small shuffle partitions.  No operator forces a
# broadcast: beyond autoBroadcastJoinThreshold every join is a shuffled one.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name: str = "folioscope", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The folder the cluster names; only a local session without one gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors reach")
        root = tempfile.mkdtemp(prefix="folioscope-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession) -> str:
    """A new folder that all executors reach."""
    return f"{_shared_root(spark)}/folioscope/{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` write to the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(_shared_root(spark))


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    files, place = _folder(spark, path)
    files.delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Checkpoints made inside go at the end; nothing that reads them may outlive it."""
    use_checkpoints(spark)
    files, place = _folder(spark, spark.sparkContext.getCheckpointDir())

    def names() -> set[str]:
        return {s.getPath().getName() for s in files.listStatus(place)} if files.exists(place) else set()

    before = names()
    try:
        yield
    finally:
        for name in names() - before:
            remove(spark, f"{place}/{name}")
