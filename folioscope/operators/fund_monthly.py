"""Customer x year x month x fund."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import times

KEYS = ["cust_id", "year", "month", "fund_code"]


def _dated(df: DataFrame, at: Column) -> DataFrame:
    return times.with_year_month(df, at).withColumn("cust_id", F.col("customer_id"))


def _clicks(fund_actions: DataFrame) -> DataFrame:
    rows = _dated(fund_actions, times.as_time(fund_actions, "timestamp"))
    return rows.select(*KEYS, F.lit(1).alias("fund_clicks"))


def _transactions(actions: DataFrame) -> DataFrame:
    rows = _dated(actions, times.as_time(actions, "timestamp")).filter(
        F.col("fund_code").isNotNull()
    )
    return rows.select(*KEYS, F.col("amount").alias("fund_transaction_volume"))


def _holdings(holdings: DataFrame) -> DataFrame:
    rows = _dated(holdings, times.year_month_day(F.col("year_month")))
    return rows.select(*KEYS, F.col("size").alias("fund_outstanding"))


def _summed(rows: DataFrame, *names: str) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[F.sum(name).alias(name) for name in names])


def fund_clicks(fund_actions: DataFrame) -> DataFrame:
    return _summed(_clicks(fund_actions), "fund_clicks")


def fund_transaction_volume(actions: DataFrame) -> DataFrame:
    """All amounts with a fund code, the placeholder of fundless actions included."""
    return _summed(_transactions(actions), "fund_transaction_volume")


def fund_outstanding(holdings: DataFrame) -> DataFrame:
    return _summed(_holdings(holdings), "fund_outstanding")


def summary_year_month_fund(
    fund_actions: DataFrame, actions: DataFrame, holdings: DataFrame
) -> DataFrame:
    """The three measures side by side, for every key any of them has.

    A union and one grouping give what full outer joins would, with a single
    shuffle of pre-aggregated rows.  Rows whose fund is unknown never match
    across sources in a join, so their source joins the grouping key.
    """
    sources = [_clicks(fund_actions), _transactions(actions), _holdings(holdings)]
    rows = None
    for number, source in enumerate(sources):
        tagged = source.withColumn("__alone", F.when(F.col("fund_code").isNull(), F.lit(number)))
        rows = tagged if rows is None else rows.unionByName(tagged, allowMissingColumns=True)
    measures = ("fund_clicks", "fund_outstanding", "fund_transaction_volume")
    return (
        rows.groupBy(*KEYS, "__alone")
        .agg(*[F.sum(name).alias(name) for name in measures])
        .drop("__alone")
    )
