"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioscope.session import use_checkpoints

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROWS_AT_ONCE = 128
SHORT = 64  # characters of a pre-token worth remembering
PIECES_AT_ONCE = 1 << 16
Columns = dict[str, tuple[str, pa.DataType]]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows kept in the cluster's shared checkpoint folder, the lineage cut."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text):
    """A-Z lower-cased, all other characters as they are; NULL as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def pre_tokens(split, words: str) -> Iterator[list[str]]:
    """The matches of a pattern, so many at a time that a very long text takes no more memory."""
    if len(words) <= PIECES_AT_ONCE:
        yield split.findall(words)
        return
    found = split.finditer(words)
    while some := [m.group() for m in islice(found, PIECES_AT_ONCE)]:
        yield some


def per_row(
    rows: DataFrame, keep: list[str], value: str, begin: Callable[[], Callable], columns: Columns
) -> DataFrame:
    """The ``keep`` columns of ``rows`` and new ones computed from ``value``, row by row.

    ``begin`` runs once per task and gives a function from a few values to their
    new columns.  ``keep`` columns pass through Arrow untouched.
    """
    chosen = rows.select(*keep, F.col(value).alias("__value"))
    new_fields = StructType.fromDDL(", ".join(f"{name} {kind}" for name, (kind, _) in columns.items()))
    schema = StructType(chosen.schema.fields[:-1] + new_fields.fields)
    types = [arrow for _, arrow in columns.values()]
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = begin()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                new = step(part.column(len(keep)).to_pylist())
                arrays = [pa.array(column, kind) for column, kind in zip(new, types)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *arrays], names=names)

    return chosen.mapInArrow(work, schema)
