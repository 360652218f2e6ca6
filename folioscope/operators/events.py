"""App events, fund views and survey answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions.times import in_window


def digital_actions(
    activity: DataFrame, ids: DataFrame, start, end, closed: bool = False
) -> DataFrame:
    """App events of eligible members by server time; missing texts become empty."""
    events = activity.filter(in_window(F.col("server_time"), start, end, closed))
    return events.join(ids, "member_serno").select(
        "customer_id",
        F.coalesce("view_name", F.lit("")).alias("view_name"),
        F.coalesce("activity", F.lit("")).alias("action"),
        F.coalesce("details", F.lit("")).alias("details"),
        F.col("client_time").alias("event_time"),
    )


def fund_actions(
    activity: DataFrame, ids: DataFrame, funds: DataFrame, start, end, closed: bool = False
) -> DataFrame:
    """Fund pages opened or left; the last three characters of the details name the fund."""
    views = activity.filter(
        F.col("view_name").isin(*K.FUND_VIEWS) & in_window(F.col("client_time"), start, end, closed)
    ).select(
        "member_serno",
        F.when(F.split_part("details", F.lit(","), F.lit(1)) == "back", "back")
        .otherwise("open")
        .alias("action_type"),
        F.right("details", F.lit(3)).alias("fund_code"),
        F.col("client_time").alias("timestamp"),
    )
    codes = funds.select(F.col("code").alias("fund_code"))
    return (
        views.join(codes, "fund_code")
        .join(ids, "member_serno")
        .select("customer_id", "action_type", "fund_code", "timestamp")
    )


def bias_results(
    results: DataFrame, instances: DataFrame, definitions: DataFrame, ids: DataFrame
) -> DataFrame:
    """Answers of completed investor-profile surveys, without the 'false' ones."""
    profile = definitions.filter(F.col("name") == K.PROFILE_SURVEY).select(
        F.col("serno").alias("definition_serno")
    )
    completed = (
        instances.filter(F.col("completed").isNotNull())
        .select(F.col("serno").alias("instance_serno"), "member_serno", "definition_serno")
        .join(profile, "definition_serno")
        .join(ids, "member_serno")
        .select("instance_serno", "customer_id")
    )
    return (
        results.filter(F.col("result_value") != "false")
        .join(completed, "instance_serno")
        .select("customer_id", "result_key", "result_value")
    )


def fund_details(funds: DataFrame) -> DataFrame:
    return funds.select("code", "risk_value", "category", "asset_class").orderBy("code")


def popular_funds(fund_lists: DataFrame) -> DataFrame:
    return (
        fund_lists.filter(F.col("list_type") == K.POPULAR_LIST)
        .select("day", "fund_code")
        .orderBy("day", "fund_code")
    )
