"""Small hand-made tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from folioscope import schemas


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def landed(spark, name: str, rows: list[tuple]):
    return spark.createDataFrame(rows, schemas.LANDED[name])


def source(spark, name: str, rows: list[tuple]):
    return spark.createDataFrame(rows, schemas.SOURCES[name])


def money(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.01"))


def rows(df, *columns):
    """The rows as sorted tuples (NULL before values)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def day(text: str) -> date:
    return date.fromisoformat(text)
