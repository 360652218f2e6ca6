"""What a run has changed: the months and the buckets of customers to build anew.

Tables that grow by loads say so themselves: a load's months follow from its
window and its buckets are read off its rows.  Tables that every run replaces are
compared with what the last successful run saw, by count and hash per month and
bucket, so the comparison moves a few numbers whatever the size of the tables.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
MONTH = "yyyy/MM"
# Which buckets a change of a whole table, of the year or of the layout touches: all.
MONTH_KIND, BUCKET_KIND, FUNDS, WHOLE = "month", "bucket", "funds", "whole"


def bucket_of(customer: str, buckets: int) -> Column:
    """The bucket of a customer, as the stored matrix is laid out by."""
    return F.pmod(F.xxhash64(customer), F.lit(buckets)).cast("int")


def fingerprint(df: DataFrame, kind: str, part: Column) -> DataFrame:
    """Count and order-free hash of the rows of each ``part``."""
    return (
        df.select(part.cast("string").alias("part"), F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h"))
        .select(F.lit(kind).alias("kind"), "part", "n", "h")
    )


def fingerprints(
    snapshot: DataFrame, by_customer: dict[str, DataFrame], funds: DataFrame, popular: DataFrame, setup: str,
    buckets: int,
) -> DataFrame:
    """Fingerprints of all that runs replace.

    ``snapshot`` is the part of the action log without a window; ``by_customer``
    are further tables of customers; ``setup`` is anything all results hang on.
    """
    risks = funds.select("code", "risk_value")
    parts = [
        fingerprint(snapshot, MONTH_KIND, F.date_format("timestamp", MONTH)),
        fingerprint(risks, FUNDS, F.lit("risks")),
        fingerprint(funds, WHOLE, F.lit("funds")),
        fingerprint(popular, WHOLE, F.lit("popular")),
        funds.sparkSession.range(1).select(
            F.lit(WHOLE).alias("kind"),
            F.lit(f"setup {setup}").alias("part"),
            F.lit(0).cast("long").alias("n"),
            F.lit(0).cast("decimal(38,0)").alias("h"),
        ),
    ]
    for name, table in {"snapshot": snapshot, **by_customer}.items():
        parts.append(fingerprint(table, f"{BUCKET_KIND} {name}", bucket_of("customer_id", buckets)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def changes(new: DataFrame, old: DataFrame | None) -> set[tuple[str, str | None]] | None:
    """Kinds and parts whose fingerprints differ; None if there is nothing to compare with."""
    if old is None:
        return None
    names = ["kind", "part", "n", "h"]
    apart = new.select(names).exceptAll(old.select(names)).union(old.select(names).exceptAll(new.select(names)))
    return {(r["kind"], r["part"]) for r in apart.select("kind", "part").distinct().collect()}


def months_to_build(changed: set | None, loaded: Iterable[str]) -> list[str] | None:
    """Months whose summaries may differ from the last run's; None for all."""
    if changed is None or any(kind == FUNDS for kind, _ in changed):
        return None
    return sorted({*loaded, *(part for kind, part in changed if kind == MONTH_KIND and part)})


def buckets_to_build(changed: set | None, loaded: Iterable[int]) -> list[int] | None:
    """Buckets of customers whose features may differ from the last run's; None for all."""
    if changed is None or any(kind in (WHOLE, FUNDS) for kind, _ in changed):
        return None
    return sorted({*loaded, *(int(part) for kind, part in changed if kind.startswith(BUCKET_KIND) and part)})


def loaded_buckets(tables: Iterable[DataFrame], buckets: int) -> set[int]:
    """Buckets with rows in any of the tables."""
    found = reduce(
        lambda a, b: a.union(b), [t.select(bucket_of("customer_id", buckets).alias("bucket")) for t in tables]
    )
    return {r["bucket"] for r in found.distinct().collect()}
