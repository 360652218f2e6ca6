"""End-of-day balances by month and by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions import times


def _in_currency(eod: DataFrame, start, end, closed: bool) -> DataFrame:
    return eod.filter(
        (F.col("currency") == K.CURRENCY)
        & times.in_window(F.col("day"), start, end, closed, dates=True)
    )


def _known(eod: DataFrame, as_of, legacy: bool) -> DataFrame:
    return eod if legacy else eod.filter(F.col("day") <= times.day(as_of))


def _month_end(as_of, legacy: bool) -> Column:
    """The month a balance belongs to, named by its last day.

    ``legacy`` files the balance of ``as_of`` itself under the day before, so
    the current month can have two last days, and the first of a month counts
    for the month before.
    """
    month_end = F.last_day("day")
    if not legacy:
        return month_end
    today = times.day(as_of)
    return F.when(F.col("day") == today, F.date_sub(today, 1)).otherwise(month_end)


def _label(month_end: str = "__month") -> Column:
    return F.date_format(month_end, "yyyy/MM").alias("year_month")


def _on_latest_day(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows of each group's latest day, all of them if several share it.

    The rank is cut at the first place before the shuffle too, so what travels is
    the latest day each task has seen and no whole history.
    """
    latest = W.partitionBy(*keys).orderBy(F.col("day").desc())
    return rows.withColumn("__rank", F.rank().over(latest)).filter("__rank = 1").drop("__rank")


def monthly_outstandings(
    eod_accounts: DataFrame,
    account_ids: DataFrame,
    start,
    end,
    as_of,
    legacy: bool = False,
    closed: bool = False,
) -> DataFrame:
    """Account balances on each member's last known day of each month.

    The label comes of an aggregate of the month: conditions on the text would
    else be moved below everything, and form and parse it for every balance.
    All accounts with a balance on that day stay separate rows.  Balances are read
    once: each account keeps its latest day of a month before it meets its member,
    and the member then keeps the latest of those.
    """
    known = _known(_in_currency(eod_accounts, start, end, closed), as_of, legacy)
    dated = known.withColumn("month_end", _month_end(as_of, legacy))
    latest = _on_latest_day(dated, "account_serno", "month_end").join(account_ids, "account_serno")
    kept = _on_latest_day(latest, "member_serno", "month_end")
    whole = W.partitionBy("member_serno", "month_end")
    return kept.withColumn("__month", F.max("month_end").over(whole)).select(
        "customer_id",
        _label(),
        F.col("size").alias("account_volume"),
        F.col("movable_size").alias("fund_volume"),
    )


def monthly_outstanding_funds(
    eod_holdings: DataFrame,
    portfolio_ids: DataFrame,
    start,
    end,
    as_of,
    legacy: bool = False,
    closed: bool = False,
) -> DataFrame:
    """Fund holdings on the last known day of each month, summed over portfolios.

    A portfolio counts if its own last day is the last one of all, so each keeps
    that day only before it meets its customer: a row per portfolio, fund and
    month goes into the join.  Laid out by portfolio, the rows are summed per
    day, cut to the last day and joined in place; no window or second read.
    """
    known = _known(_in_currency(eod_holdings, start, end, closed), as_of, legacy)
    who = ["member_serno", "customer_id", "fund_code", "month_end"]
    latest = (
        known.select("portfolio_serno", "fund_code", "day", "size")
        .repartition("portfolio_serno")
        .groupBy("portfolio_serno", "fund_code", "day")
        .agg(F.sum("size").alias("size"))
        .withColumn("month_end", _month_end(as_of, legacy))
        .groupBy("portfolio_serno", "fund_code", "month_end")
        .agg(F.max("day").alias("day"), F.max_by("size", "day").alias("size"))
    )
    of_members = latest.join(portfolio_ids, "portfolio_serno").repartition("member_serno", "fund_code")
    daily = of_members.groupBy(*who, "day").agg(F.sum("size").alias("size"))
    # As above, the label is no grouping key, so that no condition on it reaches the scan.
    monthly = daily.groupBy(*who).agg(F.max_by("size", "day").alias("size"), F.max("month_end").alias("__month"))
    labelled = monthly.select("member_serno", "customer_id", "fund_code", _label(), "size")
    if legacy:
        labelled = labelled.groupBy("member_serno", "customer_id", "fund_code", "year_month").agg(
            F.sum("size").alias("size")
        )
    return labelled.select("customer_id", "year_month", "fund_code", "size")


def daily_outstandings(
    eod_accounts: DataFrame, account_ids: DataFrame, start, end, closed: bool = False
) -> DataFrame:
    return (
        _in_currency(eod_accounts, start, end, closed)
        .join(account_ids, "account_serno")
        .select(
            "customer_id",
            F.col("size").alias("account_volume"),
            F.col("movable_size").alias("fund_volume"),
            F.col("day").alias("date"),
        )
    )
