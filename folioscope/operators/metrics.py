"""Monthly metrics in the form analysts export them: upper-case columns, own rules.

They differ from the summaries on purpose; each says how.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions import times
from folioscope.functions.numbers import float_ratio, percent_text, ratio, round_even_2

KEYS = ["CUST_ID", "YEAR", "MONTH"]
BUCKETS = (*K.HOUR_BUCKETS, K.NIGHT)


def _dated(df: DataFrame, at: Column) -> DataFrame:
    """Rows with a time, under the keys; others fall out as they do of a grouping."""
    return df.filter(at.isNotNull()).withColumns(
        {"CUST_ID": F.col("customer_id"), "YEAR": F.year(at), "MONTH": F.month(at)}
    )


def _timed(df: DataFrame, pattern: str = K.DISPLAY_PATTERN) -> DataFrame:
    return _dated(df, times.as_time(df, "timestamp", pattern))


def _views(fund_actions: DataFrame) -> DataFrame:
    return _timed(fund_actions, K.DISPLAY_PATTERN_SECONDS)


def _month_rows(df: DataFrame) -> DataFrame:
    return _dated(df, times.year_month_day(F.col("year_month")))


def _risk_of(df: DataFrame, funds: DataFrame) -> DataFrame:
    """Add the fund's risk; NULL for a fund that is not known."""
    risks = funds.select(F.col("code").alias("fund_code"), "risk_value")
    return df.join(risks, "fund_code", "left")


def activity_score_scaled(actions: DataFrame) -> DataFrame:
    """Monthly action counts scaled to 0..100 over the whole table; NaN if all are equal.

    Lowest and highest count are one scalar subquery, so no window or join sees
    the whole table and the log is read for both at once.
    """
    counts = _timed(actions).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    ends = counts.agg(F.struct(F.min("n").alias("low"), F.max("n").alias("high"))).scalar()
    lowest, highest = F.col("ends.low"), F.col("ends.high")
    share = ratio(F.col("n") - lowest, highest - lowest) * 100
    score = F.when(highest == lowest, F.lit(float("nan"))).otherwise(round_even_2(share))
    return counts.select(*KEYS, "n", ends.alias("ends")).select(*KEYS, score.alias("ACTIVITY_SCORE"))


def hour_bucket_pct(actions: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Share of actions per part of the day, as text.

    ``fill_missing`` adds the older behaviour: if some part of the day occurs
    nowhere in the table, every customer gets a row for every year and month
    that occur, reading ``0%`` where the customer did nothing.
    """
    at = times.as_time(actions, "timestamp")
    rows = _dated(actions, at).select(*KEYS, times.hour_bucket(at).alias("bucket"))
    counts = rows.groupBy(*KEYS).agg(
        *[F.count_if(F.col("bucket") == name).alias(name) for name in BUCKETS]
    )
    if fill_missing:
        counts = _with_idle_months(counts)
    total = sum((F.col(name) for name in BUCKETS[1:]), F.col(BUCKETS[0]))
    return counts.select(
        *KEYS,
        *[
            percent_text(F.col(name), total).alias(f"{name.upper()}_ACTIVITY_PERCENTAGE")
            for name in BUCKETS
        ],
    )


def _with_idle_months(counts: DataFrame) -> DataFrame:
    """Zero rows for idle months, only if some part of the day is absent everywhere.

    Years and months are bounded sets (a table spans few years), so they are one
    scalar subquery, with the sums of the parts.  A customer's months, no more than
    the table has, are gathered in one row; the idle ones are added to that list
    and all are listed as they are read, so no row that is filled in is shuffled
    or held.
    """
    absent = F.least(*[F.sum(name) for name in BUCKETS]) == 0
    ends = counts.agg(
        F.struct(absent.alias("absent"), F.collect_set("YEAR").alias("years"), F.collect_set("MONTH").alias("months"))
    )
    of_customer = counts.groupBy("CUST_ID").agg(
        F.collect_list(F.struct(F.expr("YEAR * 12 + MONTH - 1").alias("at"), *BUCKETS)).alias("busy")
    )
    every = "flatten(transform(ends.years, y -> transform(ends.months, m -> y * 12 + m - 1)))"
    idle = f"array_except(if(ends.absent, {every}, array()), busy.at)"
    zeros = ", ".join(f"'{name}', 0L" for name in BUCKETS)
    return (
        of_customer.withColumn("ends", ends.scalar())
        .selectExpr("CUST_ID", f"inline(concat(busy, transform({idle}, x -> named_struct('at', x, {zeros}))))")
        .selectExpr("CUST_ID", "CAST(at DIV 12 AS INT) AS YEAR", "at % 12 + 1 AS MONTH", *BUCKETS)
    )


def fund_balance_ratio_rows(monthly: DataFrame) -> DataFrame:
    """One ratio per input row, sorted; an empty account gives infinity or NaN."""
    return (
        _month_rows(monthly)
        .select(
            *KEYS,
            float_ratio(F.col("fund_volume"), F.col("account_volume")).alias("FUND_BALANCE_RATIO"),
        )
        .orderBy(*KEYS)
    )


def fund_clicks_pd(fund_actions: DataFrame) -> DataFrame:
    return (
        _views(fund_actions)
        .filter(F.col("fund_code").isNotNull())
        .groupBy(*KEYS, F.col("fund_code").alias("FUND_CODE"))
        .agg(F.count(F.lit(1)).alias("FUND_CLICKS"))
    )


def fund_outstanding_rows(holdings: DataFrame) -> DataFrame:
    """A projection: nothing is summed."""
    return _month_rows(holdings).select(
        *KEYS, F.col("fund_code").alias("FUND_CODE"), F.col("size").alias("FUND_OUTSTANDING")
    )


def _trades(actions: DataFrame) -> DataFrame:
    return _timed(actions.filter(F.col("action_type").isin(K.FUND_BUY, K.FUND_SELL)))


def fund_transaction_volume_pd(actions: DataFrame) -> DataFrame:
    """Purchases and sales only."""
    return (
        _trades(actions)
        .filter(F.col("fund_code").isNotNull())
        .groupBy(*KEYS, F.col("fund_code").alias("FUND_CODE"))
        .agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("FUND_TRANSACTION_VOLUME"))
    )


def interested_fund_count_pd(fund_actions: DataFrame) -> DataFrame:
    """Openings per month; the column named CUST_ID holds the action type."""
    opened = _views(fund_actions).filter(F.col("action_type") == "open")
    return opened.groupBy("YEAR", "MONTH", "action_type").agg(
        F.count("fund_code").alias("INTERESTED_FUND_COUNT")
    ).withColumnRenamed("action_type", "CUST_ID")


def interested_fund_risk_pd(fund_actions: DataFrame, funds: DataFrame) -> DataFrame:
    """Summed risk over openings; openings of unknown funds count with no risk."""
    opened = _views(fund_actions).filter(F.col("action_type") == "open")
    risk = F.coalesce(F.sum("risk_value"), F.lit(0))
    return (
        _risk_of(opened, funds)
        .groupBy(*KEYS)
        .agg(round_even_2(ratio(risk, F.count(F.lit(1)))).alias("INTERESTED_FUND_RISK"))
    )


def outstanding_trend_diff(daily: DataFrame) -> DataFrame:
    """-1, 0 or 1: whether the balance fell or rose over the month, day by day.

    The daily changes are added up; a change from or to a missing balance
    counts as none.  Rows of one day follow in order of their balances, missing
    ones first: so a day adds the distance from its lowest to its highest, and
    joins the day before only if none is missing.  One row per day, 31 a month
    at most, is all that the window sees.
    """
    at, volume = times.as_day(daily, "date"), F.col("account_volume")
    by_day = (
        _dated(daily, at)
        .groupBy(*KEYS, at.alias("day"))
        .agg(
            F.min(volume).alias("low"),
            F.max(volume).alias("high"),
            F.bool_or(volume.isNull()).alias("has_missing"),
        )
    )
    before = F.lag("high").over(W.partitionBy(*KEYS).orderBy("day"))
    step = F.when(~F.col("has_missing"), F.col("low") - before)
    change = F.coalesce(step, F.lit(0)) + F.coalesce(F.col("high") - F.col("low"), F.lit(0))
    return (
        by_day.select(*KEYS, change.alias("change"))
        .groupBy(*KEYS)
        .agg(F.signum(F.sum("change")).cast("int").alias("OUTSTANDING_TREND"))
    )


def owned_fund_count_pd(holdings: DataFrame) -> DataFrame:
    """Rows, not different funds."""
    return _month_rows(holdings).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("OWNED_FUND_COUNT"))


def owned_fund_risk_pd(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Weighted risk; the size of unknown funds stays in the denominator."""
    weighted = F.coalesce(F.sum(F.col("risk_value") * F.col("size")), F.lit(0))
    size = F.coalesce(F.sum("size"), F.lit(0))
    return (
        _risk_of(_month_rows(holdings), funds)
        .groupBy(*KEYS)
        .agg(round_even_2(float_ratio(weighted, size)).alias("OWNED_FUND_RISK"))
    )


def transaction_volume_pd(actions: DataFrame) -> DataFrame:
    """Months without a purchase or sale have no row."""
    return (
        _trades(actions)
        .groupBy(*KEYS)
        .agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("TRANSACTION_VOLUME"))
    )


def average_outstanding_pd(daily: DataFrame) -> DataFrame:
    return (
        _dated(daily, times.as_day(daily, "date"))
        .groupBy(*KEYS)
        .agg(ratio(F.sum("account_volume"), F.count("account_volume")).alias("AVERAGE_OUTSTANDING"))
    )


def table_fingerprint(df: DataFrame, keyword: str) -> DataFrame:
    """A keyed fingerprint of a table that does not depend on row order.

    Each row hashes with the keyword; the fingerprint is the number of rows and
    the sums of the parts of their hashes, which together are the whole hash.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    digest = F.sha2(F.concat_ws("\x1f", F.lit(keyword), *fields), 256)
    parts = [F.conv(F.substring(digest, at, 8), 16, 10).cast("decimal(38,0)") for at in range(1, 65, 8)]
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.concat_ws("-", *(F.sum(part).cast("string") for part in parts)).alias("fingerprint"),
    )
