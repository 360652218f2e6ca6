"""Who is in scope, and under which id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.functions.times import display_timestamp


ELIGIBLE = (
    "status = 'A' AND mobile_number_verified = '1' AND (account_ready_time IS NOT NULL"
    " OR (account_type = 'named' AND registration_time IS NOT NULL))"
)


def eligible_members(members: DataFrame) -> DataFrame:
    """Active, mobile-verified members that opened an account or registered by name."""
    return members.filter(ELIGIBLE).select("serno").distinct()


def member_by_id(members: DataFrame, serno: int) -> DataFrame:
    return members.filter(F.col("serno") == serno).select("serno")


def active_account_members(accounts: DataFrame, member_serno: int) -> DataFrame:
    """One row per active account of the member."""
    return (
        accounts.filter((F.col("status") == "A") & (F.col("member_serno") == member_serno))
        .select("member_serno")
        .orderBy("member_serno")
    )


def members_without_account_sample(
    members: DataFrame, size: int, seed: int = 42, digits: int = 4
) -> DataFrame:
    """A random sample of registered members that have no account yet.

    The order is a hash of seed and id, so the same seed draws the same members
    whatever the partitioning, also when a lost task runs again.  A histogram of
    the hash's first hexadecimal ``digits`` gives the first value below which
    enough members lie; the others are filtered out before anything is sorted, so
    hardly more than ``size`` rows travel.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("serno").cast("string")))
    candidates = members.filter(
        (F.col("status") == "A")
        & (F.col("account_type") == "named")
        & F.col("registration_time").isNotNull()
        & (F.col("mobile_number_verified") == "1")
        & F.col("account_ready_time").isNull()
    ).select("serno", F.coalesce(draw, F.lit("")).alias("draw"))
    counts = candidates.groupBy(F.substring("draw", 1, digits).alias("head")).count()
    enough = (
        counts.withColumn("before", F.sum("count").over(W.orderBy("head")) - F.col("count"))
        .filter(F.col("before") < size)
        .agg(F.max("head").alias("head"))
    )
    return (
        candidates.filter(F.substring("draw", 1, digits) <= enough.scalar())
        .orderBy("draw", "serno")
        .limit(size)
        .select("serno")
    )


def id_mapping(mapping: DataFrame) -> DataFrame:
    """The random id of each member; one row per member, so no join can fan out."""
    return mapping.groupBy(F.col("actual_serno").alias("member_serno")).agg(
        F.max("random_serno").alias("random_serno")
    )


def pseudonymize(
    df: DataFrame, mapping: DataFrame, column: str = "member_serno", strict: bool = False
) -> DataFrame:
    """Replace the real id in ``column`` by ``customer_id``.

    Members without a random id keep the real one; ``strict`` drops their rows.
    """
    ids = id_mapping(mapping).withColumnRenamed("member_serno", "__actual")
    joined = df.join(ids, df[column] == ids["__actual"], "inner" if strict else "left")
    rest = [c for c in df.columns if c != column]
    return joined.select(F.coalesce("random_serno", column).alias("customer_id"), *rest)


def customer_ids(members: DataFrame, mapping: DataFrame, strict: bool = False) -> DataFrame:
    """``member_serno -> customer_id`` of the eligible members, each once.

    Fact tables join this once: the check of eligibility and the change of id
    happen in one shuffle of the large side.
    """
    random_ids = mapping.selectExpr("actual_serno AS member_serno", "random_serno")
    return (
        members.filter(ELIGIBLE)
        .selectExpr("serno AS member_serno")
        .join(random_ids, "member_serno", "inner" if strict else "left")
        .groupBy("member_serno")
        .agg(F.expr("coalesce(max(random_serno), member_serno) AS customer_id"))
    )


def id_collisions(ids: DataFrame) -> DataFrame:
    """Customer ids that two members share (a kept real id equal to a random one)."""
    return ids.groupBy("customer_id").count().filter(F.col("count") > 1).select("customer_id")


def account_customers(accounts: DataFrame, ids: DataFrame) -> DataFrame:
    """``account_serno -> member_serno, customer_id``."""
    return accounts.select(F.col("serno").alias("account_serno"), "member_serno").join(
        ids, "member_serno"
    )


def portfolio_customers(portfolios: DataFrame, account_ids: DataFrame) -> DataFrame:
    """``portfolio_serno -> member_serno, customer_id``."""
    return (
        portfolios.select(F.col("serno").alias("portfolio_serno"), "account_serno")
        .join(account_ids, "account_serno")
        .drop("account_serno")
    )


def member_details(members: DataFrame, ids: DataFrame) -> DataFrame:
    return members.join(ids, members["serno"] == ids["member_serno"]).select(
        "customer_id",
        "birth_year",
        "occupation",
        "education",
        "interest_preference",
        "registration_time",
        "account_ready_time",
    )


def recorded_ibans(ibans: DataFrame) -> DataFrame:
    """Bank accounts by member, the one used last first, missing dates before it."""
    return ibans.select("member_serno", "status", "last_used_date").orderBy(
        "member_serno", F.col("last_used_date").desc_nulls_first()
    )


def display_details(details: DataFrame) -> DataFrame:
    """Member details with both times as display text."""
    return details.withColumns(
        {c: display_timestamp(F.col(c)) for c in ("registration_time", "account_ready_time")}
    )
