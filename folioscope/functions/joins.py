"""Joins that stay spread when one key holds much of the large side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
MOST_KEYS = 10_000
SALT, SALTS = "__salt", "__salts"


def heavy_keys(df: DataFrame, key: str, target: int = ROWS_PER_TASK, most: int = MOST_KEYS) -> DataFrame:
    """Keys with more than ``target`` rows, and in how many parts each is to be dealt.

    At most ``most`` of them, the heaviest: what is left out has fewer rows than
    one in ``most`` of all, so it is no more than a task's share of a job that
    large.  The rows are counted, pre-aggregated per task.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > target)
    return (
        counted.orderBy(F.desc("__n"), key)
        .limit(most)
        .select(key, F.ceil(F.col("__n") / target).cast("long").alias(SALTS))
    )


def salted_join(
    large: DataFrame, small: DataFrame, key: str, spread: Sequence[str], target: int = ROWS_PER_TASK
) -> DataFrame:
    """Inner join on ``key``, the rows of a heavy key spread over as many partitions as it needs.

    Spark splits a hot partition of a join by itself, but not where a later
    grouping or window by the same key would use the join's partitioning: the
    split would cost a shuffle that was not planned.  There the salt makes both
    the spread and that shuffle part of the plan.  The number of salts follows
    the measured rows of the key; the salt is a hash of the ``spread`` columns, so
    a task that runs again salts its rows alike.

    The list of heavy keys is broadcast: its length has a bound.  ``small`` is
    copied once per salt of its key; it must have few rows per key.
    """
    heavy = F.broadcast(heavy_keys(large, key, target))
    salts = F.coalesce(F.col(SALTS), F.lit(1).cast("long"))
    salted = large.join(heavy, key, "left").withColumn(SALT, F.pmod(F.xxhash64(*spread), salts)).drop(SALTS)
    every = F.sequence(F.lit(0).cast("long"), salts - 1)
    copies = small.join(heavy, key, "left").withColumn(SALT, F.explode(every)).drop(SALTS)
    return salted.join(copies, [key, SALT]).drop(SALT)
