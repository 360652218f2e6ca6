"""Ordered computations over one key's history, split into chunks of time.

A plain window over a customer puts that customer's whole history into one
task.  Here the window runs per (key, chunk), so a customer with a third of all
rows is spread over as many tasks as the history has chunks.  What one chunk
needs from the earlier ones is carried over from a summary with one row per
(key, chunk), read off the last row of each chunk.  Rows and summary need the
same columns in the same order, so both come out of one shuffle.  Key columns
must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = "__chunk"


def _within(df: DataFrame, keys: Sequence[str], order: Sequence[str]):
    """Rows of one key and chunk in order; all other columns break ties."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    return W.partitionBy(*keys, CHUNK).orderBy(*order, *rest)


def _last_rows(chunked: DataFrame, within) -> DataFrame:
    """The last row of each key and chunk."""
    return chunked.withColumn("__next", F.lead(F.lit(1)).over(within)).filter("__next IS NULL")


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: str, name: str
) -> DataFrame:
    """``lag(value)`` per ``keys`` in ``order``; ``chunk`` must not decrease along it."""
    keys = list(keys)
    within = _within(df, keys, order)
    chunked = df.withColumn(CHUNK, chunk)
    lagged = chunked.withColumns(
        {"__lag": F.lag(value).over(within), "__pos": F.row_number().over(within)}
    )
    carried = _last_rows(chunked, within).select(
        *keys, CHUNK, F.lag(value).over(W.partitionBy(*keys).orderBy(CHUNK)).alias("__carry")
    )
    return lagged.join(carried, [*keys, CHUNK]).selectExpr(
        *df.columns, f"CASE WHEN __pos = 1 THEN __carry ELSE __lag END AS {name}"
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    chunk: Column,
    value: str,
    name: str,
    apart: bool = False,
) -> DataFrame:
    """``sum(value)`` up to and with the current ``order`` value; equal ones share the sum.

    With ``apart`` the sum ends at the row itself; rows of equal ``order`` go by
    their other columns.
    """
    keys = list(keys)
    within = _within(df, keys, [order])
    if apart:
        peers = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    else:
        peers = (
            W.partitionBy(*keys, CHUNK)
            .orderBy(order)
            .rangeBetween(W.unboundedPreceding, W.currentRow)
        )
    summed = df.withColumn(CHUNK, chunk).withColumn("__sum", F.sum(value).over(peers))
    before = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carried = _last_rows(summed, within).select(
        *keys, CHUNK, F.sum("__sum").over(before).alias("__carry")
    )
    return summed.join(carried, [*keys, CHUNK]).selectExpr(
        *df.columns, f"__sum + coalesce(__carry, 0) AS {name}"
    )


def numbered_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    chunk: Column,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """Add ``previous``, ``is_new`` and ``run``: which run of equal values a row is in.

    Rows go by ``order``, then ``value``; a row begins a run if its value is not the
    one before, and rows of equal ``order`` share the number reached after all of
    them.  ``chunk`` must not decrease along ``order``.

    One pass over the rows works within chunks.  What a chunk means for later ones
    is its first value, its last one and its changes in between; those of
    neighbouring chunks join into those of both, so one pass over the summaries,
    a row per chunk, gives the value before each chunk and the number of its first
    run.  ``per_key`` (a row per key) travels with the summaries; keys it lacks fall out.
    """
    keys = list(keys)
    within = W.partitionBy(*keys, CHUNK).orderBy(order, value)
    peers = (
        W.partitionBy(*keys, CHUNK).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    # Said for both uses of the rows, so that they share one shuffle.
    known = " AND ".join(f"{name} IS NOT NULL" for name in (*keys, CHUNK))
    placed = df.withColumn(CHUNK, chunk).filter(known).withColumns(
        {"__lag": F.lag(value).over(within), "__pos": F.row_number().over(within)}
    )
    changed = placed.withColumn("__new", F.when(F.col("__pos") > 1, F.col(value) != F.col("__lag")).cast("int"))
    summed = changed.withColumn("__run", F.coalesce(F.sum("__new").over(peers), F.lit(0)))
    ends = summed.withColumns(
        {"__next": F.lead(F.lit(1)).over(within), "__first": F.first(value).over(within)}
    )
    chunks = ends.filter("__next IS NULL").select(
        *keys, CHUNK, "__first", F.col(value).alias("__last"), F.col("__run").alias("__changes")
    )
    if per_key is not None:
        chunks = chunks.join(per_key, keys)
    in_order = W.partitionBy(*keys).orderBy(CHUNK)
    met = chunks.withColumn("__previous", F.lag("__last").over(in_order)).withColumn(
        "__starts", F.expr("int(__previous IS NULL OR __first != __previous)")
    )
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    carried = met.withColumn(
        "__carry", F.coalesce(F.sum(F.col("__changes") + F.col("__starts")).over(before), F.lit(0)) + F.col("__starts")
    ).drop("__first", "__last", "__changes")
    more = [] if per_key is None else [c for c in per_key.columns if c not in keys]
    return summed.join(carried, [*keys, CHUNK]).selectExpr(
        *df.columns,
        *more,
        "CASE WHEN __pos = 1 THEN __previous ELSE __lag END AS previous",
        "CASE WHEN __pos = 1 THEN __starts ELSE __new END AS is_new",
        "__carry + __run AS run",
    )
