"""Reading source tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from folioscope import schemas


def source_scan(
    table: DataFrame, columns: Sequence[str] | None = None, where: Column | None = None
) -> DataFrame:
    """The rows and columns asked for; both reach the scan."""
    rows = table if where is None else table.filter(where)
    return rows if columns is None else rows.select(*columns)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, read in ranges of ``partition_column`` when bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


class StoredSources(Mapping):
    """Sources of which the ``names`` come from ``store``, asked once each.

    For sources that are costly to derive and that several tables or windows read.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        names: Sequence[str],
        store: Callable[[str, DataFrame], DataFrame],
    ):
        self.sources, self.names, self.store = sources, names, store
        self._stored: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            return self.sources[name]
        if name not in self._stored:
            self._stored[name] = self.store(name, self.sources[name])
        return self._stored[name]

    def __iter__(self):
        return iter(self.sources)

    def __len__(self) -> int:
        return len(self.sources)


class ParquetSources(Mapping):
    """Source tables by name, one parquet folder each under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        schema = schemas.SOURCES[name]
        return schemas.conform(self.spark.read.parquet(f"{self.root}/{name}"), schema)

    def __iter__(self):
        return iter(schemas.SOURCES)

    def __len__(self) -> int:
        return len(schemas.SOURCES)
