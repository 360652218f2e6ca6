"""Customer x year x month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions import times
from folioscope.functions.numbers import percent_of, ratio

KEYS = ["cust_id", "year", "month"]


def _by_month(df: DataFrame, at: Column):
    """Group by customer and calendar month of ``at``; rows without a time fall out."""
    dated = times.with_year_month(df, at)
    return dated.groupBy(F.col("customer_id").alias("cust_id"), "year", "month")


def _actions(actions: DataFrame):
    return _by_month(actions, times.as_time(actions, "timestamp"))


def _outstanding(daily: DataFrame):
    return _by_month(daily, times.as_day(daily, "date"))


def _year_month(table: DataFrame):
    return _by_month(table, times.year_month_day(F.col("year_month")))


def _risks(funds: DataFrame) -> DataFrame:
    return funds.select(F.col("code").alias("fund_code"), "risk_value")


# Aggregates.  Sums stay exact decimals until a ratio is taken.


def _transaction_volume() -> Column:
    traded = F.col("action_type").isin(K.FUND_BUY, K.FUND_SELL)
    return F.sum(F.when(traded, F.col("amount")).otherwise(0)).alias("transaction_volume")


def _activity_count() -> Column:
    return F.count(F.lit(1)).alias("activity_score")


def _hour_counts(at: Column) -> list[Column]:
    bucket = times.hour_bucket(at)
    return [F.count_if(bucket == name).alias(name) for name in (*K.HOUR_BUCKETS, K.NIGHT)]


def _average_outstanding() -> Column:
    return ratio(F.sum("account_volume"), F.count("account_volume")).alias("average_outstanding")


def _outstanding_trend() -> Column:
    """1 if the balance moved within the month, else 0."""
    spread = F.max("account_volume") - F.min("account_volume")
    return F.when(spread > 0, 1).otherwise(0).alias("outstanding_trend")


def _fund_count(name: str) -> Column:
    """Different funds, exactly, in the one shuffle by customer and month.

    Sets are built per task first; one is never longer than the list of funds.
    """
    return F.size(F.collect_set("fund_code")).cast("bigint").alias(name)


def _opened_risk() -> Column:
    risk = F.when(F.col("action_type") == "open", F.col("risk_value"))
    return ratio(F.sum(risk), F.count(risk)).alias("interested_fund_risk")


def _held_risk() -> Column:
    known = F.when(F.col("risk_value").isNotNull(), F.col("size"))
    return ratio(F.sum(F.col("risk_value") * known), F.sum(known)).alias("owned_fund_risk")


def ym_volumes(monthly: DataFrame) -> DataFrame:
    """Month-end balances per customer; texts that name no month are left out."""
    return _year_month(monthly).agg(
        F.sum("fund_volume").alias("fund_volume"), F.sum("account_volume").alias("account_volume")
    )


def ym_transaction_volume(actions: DataFrame) -> DataFrame:
    """Bought and sold amounts; months with other actions only read 0."""
    return _actions(actions).agg(_transaction_volume())


def ym_activity_count(actions: DataFrame) -> DataFrame:
    return _actions(actions).agg(_activity_count())


def ym_interested_fund_count(fund_actions: DataFrame) -> DataFrame:
    """Different funds looked at, opened or left."""
    return _actions(fund_actions).agg(_fund_count("interested_fund_count"))


def ym_average_outstanding(daily: DataFrame) -> DataFrame:
    return _outstanding(daily).agg(_average_outstanding())


def ym_outstanding_trend(daily: DataFrame) -> DataFrame:
    return _outstanding(daily).agg(_outstanding_trend())


def ym_interested_fund_risk(fund_actions: DataFrame, funds: DataFrame) -> DataFrame:
    """Average risk of the funds opened, once per opening."""
    opened = fund_actions.filter(F.col("action_type") == "open").join(_risks(funds), "fund_code")
    return _actions(opened).agg(_opened_risk())


def ym_owned_fund_count(holdings: DataFrame) -> DataFrame:
    return _year_month(holdings).agg(_fund_count("owned_fund_count"))


def ym_owned_fund_risk(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Risk of the funds held, weighted by size."""
    return _year_month(holdings.join(_risks(funds), "fund_code")).agg(_held_risk())


def ym_hourly_activity(actions: DataFrame) -> DataFrame:
    at = times.as_time(actions, "timestamp")
    return _by_month(actions, at).agg(*_hour_counts(at))


def summary_year_month(
    monthly: DataFrame,
    actions: DataFrame,
    fund_actions: DataFrame,
    daily: DataFrame,
    holdings: DataFrame,
    funds: DataFrame,
) -> DataFrame:
    """All monthly measures of customers that have a month-end balance.

    Each table is grouped once.  All five results are partitioned by the same
    three keys, so the joins add no shuffle.  Unknown funds stay in the rows
    (they count as funds) but not in the risks.
    """
    at = times.as_time(actions, "timestamp")
    risks = _risks(funds)
    parts = [
        ym_volumes(monthly),
        _by_month(actions, at).agg(_transaction_volume(), _activity_count(), *_hour_counts(at)),
        _actions(fund_actions.join(risks, "fund_code", "left")).agg(
            _fund_count("interested_fund_count"), _opened_risk()
        ),
        _outstanding(daily).agg(_average_outstanding(), _outstanding_trend()),
        _year_month(holdings.join(risks, "fund_code", "left")).agg(
            _fund_count("owned_fund_count"), _held_risk()
        ),
    ]
    wide = reduce(lambda left, right: left.join(right, KEYS, "left"), parts)
    total = sum((F.col(name) for name in K.HOUR_BUCKETS), F.col(K.NIGHT))
    percentages = [
        percent_of(F.col(name), total).alias(f"{name}_activity_percentage")
        for name in (*K.HOUR_BUCKETS, K.NIGHT)
    ]
    return wide.select(
        *KEYS,
        ratio(F.col("fund_volume"), F.col("account_volume")).alias("fund_balance_ratio"),
        "average_outstanding",
        "outstanding_trend",
        "interested_fund_count",
        "interested_fund_risk",
        "transaction_volume",
        "owned_fund_count",
        "owned_fund_risk",
        "activity_score",
        *percentages,
    )
