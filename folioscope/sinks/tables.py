"""Writing landed tables, the upload log and row counts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import constants as K
from folioscope.sinks.versions import (
    SCHEMA,
    Folder,
    begin_version,
    current_path,
    current_version,
    switch_version,
)

LOAD = "load"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current rows of a table, in the columns and types it was written with.

    The schema stands beside the rows, so no file is opened to learn it and a
    table without rows has its columns too.  ``schema`` takes its place for
    folders that other programs have written.
    """
    where = current_path(spark, path)
    folder = Folder(spark, where)
    if schema is None and SCHEMA in folder.names():
        schema = T.StructType.fromJson(json.loads(folder.read_text(SCHEMA)))
        return spark.read.schema(schema).parquet(where).select(*schema.names)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(where)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "replace",
    load: str | None = None,
    partition_by: Sequence[str] = (),
    restart: bool = False,
    covered: Sequence[str | Sequence] = (),
) -> int:
    """Write ``df`` and return the number of rows, counted during the write.

    ``replace`` writes the whole table anew as a version of its own, which readers
    get from the moment it is complete; ``df`` may read the table itself.
    ``append`` adds a partition ``load=<name>`` to the current version and
    replaces just that one, so a run that is repeated after a failure adds
    nothing twice.  ``partitions`` overwrites the partitions of ``partition_by``
    that occur in ``df``; of those named in ``covered`` (values of its first
    columns, few) any without rows is removed.  ``restart`` drops what the table
    holds in any mode, by a new version too.
    """
    spark = df.sparkSession
    counted = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    rows = df
    wanted = [(value,) if isinstance(value, str) else tuple(value) for value in covered]
    if mode == "append" and load is None:
        raise ValueError("append needs the name of the load")
    if mode == "partitions":
        for number, values in enumerate(wanted):
            here = [F.col(name) == value for name, value in zip(partition_by, values)]
            metrics.append(F.count_if(reduce(lambda a, b: a & b, here)).alias(f"in {number}"))
    elif mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    if partition_by:
        # Few files per partition, and several for one that holds most rows.
        rows = rows.hint("rebalance", *partition_by)
    version = current_version(spark, path)
    anew = mode == "replace" or restart or version is None
    if anew:
        version = begin_version(spark, path)
    folder = Folder(spark, f"{path}/{version}")
    # A load is written aside: a repeated one may have other partitions than before.
    aside = f"_load-{uuid.uuid4().hex}" if mode == "append" else ""
    writer = rows.observe(counted, *metrics).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "partitions" and not anew:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(f"{path}/{version}/{aside}".rstrip("/"))
    found = counted.get
    if mode == "append":
        name = _folder_of({LOAD: load})
        folder.remove(name)
        if found["rows"]:
            folder.rename(aside, name)
        folder.remove(aside)
    if anew:
        kept = T.StructType([*rows.schema.fields, T.StructField(LOAD, T.StringType())])
        folder.write_text(SCHEMA, (kept if mode == "append" else rows.schema).json())
        switch_version(spark, path, version)
    elif mode == "partitions":
        for number, values in enumerate(wanted):
            if not found[f"in {number}"]:  # overwriting with no rows leaves the old ones
                folder.remove(_folder_of(dict(zip(partition_by, values))))
    return found["rows"]


def _folder_of(values: Mapping[str, object]) -> str:
    """The name of a partition's folder."""
    return "/".join(f"{name}={quote(str(value), safe='')}" for name, value in values.items())


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, **options: str) -> None:
    """Write to a database; ``replace`` empties the table but keeps its definition."""
    spark_mode = {"replace": "overwrite", "append": "append"}[mode]
    df.write.format("jdbc").mode(spark_mode).options(
        url=url, dbtable=table, batchsize=str(K.JDBC_BATCH), truncate="true", **options
    ).save()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, table in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def upload_log(entries: DataFrame) -> DataFrame:
    """The log as a table: per day and table the count logged last.

    ``entries`` has ``log_date, table_name, row_count, logged_at``.
    """
    newest = F.max_by("row_count", F.struct("logged_at", "row_count"))
    return entries.groupBy("log_date", "table_name").agg(newest.alias("row_count"))


def merge_log(entries: DataFrame, path: str) -> int:
    """Lay ``entries`` over the log at ``path``; it keeps one row per day and table."""
    spark = entries.sparkSession
    every = entries
    if current_version(spark, path):
        every = read_table(spark, path).unionByName(entries)
    newest = F.max_by(F.struct("row_count", "logged_at"), F.struct("logged_at", "row_count"))
    kept = every.groupBy("log_date", "table_name").agg(newest.alias("newest"))
    return write_table(kept.select("log_date", "table_name", "newest.*"), path)
