"""Explicit schemas of the source tables and of the landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(28,2)": T.DecimalType(28, 2),
}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


SOURCES = {
    "members": _schema(
        "serno bigint, status string, account_type string, registration_time timestamp_ntz, "
        "mobile_number_verified string, account_ready_time timestamp_ntz, birth_year int, "
        "occupation string, education string, interest_preference string, "
        "creation_time timestamp_ntz, profile_picture string"
    ),
    "serno_mapping": _schema("actual_serno bigint, random_serno bigint"),
    "activity": _schema(
        "member_serno bigint, view_name string, activity string, details string, "
        "client_time timestamp_ntz, server_time timestamp_ntz"
    ),
    "accounts": _schema("serno bigint, member_serno bigint, status string"),
    "portfolios": _schema("serno bigint, account_serno bigint, type string, create_date date"),
    "eod_holdings": _schema(
        "portfolio_serno bigint, fund_code string, currency string, day date, size decimal(18,2)"
    ),
    "eod_accounts": _schema(
        "account_serno bigint, day date, currency string, size decimal(18,2), "
        "movable_size decimal(18,2)"
    ),
    "transactions": _schema(
        "serno bigint, account_serno bigint, tx_type string, tx_time timestamp_ntz, "
        "amount decimal(18,2), fund_code string"
    ),
    "fund_orders": _schema(
        "serno bigint, portfolio_serno bigint, status string, cancelled_by string, "
        "cancel_time timestamp_ntz, amount decimal(18,2), fund_code string"
    ),
    "recorded_ibans": _schema("member_serno bigint, status string, last_used_date date"),
    "funds": _schema("code string, risk_value int, category string, asset_class string"),
    "fund_lists": _schema("day date, fund_code string, list_type string"),
    "survey_definitions": _schema("serno bigint, name string"),
    "survey_instances": _schema(
        "serno bigint, member_serno bigint, definition_serno bigint, completed timestamp_ntz"
    ),
    "survey_results": _schema("instance_serno bigint, result_key string, result_value string"),
}

LANDED = {
    "fund_actions": _schema(
        "customer_id bigint, action_type string, fund_code string, timestamp timestamp_ntz"
    ),
    "actions": _schema(
        "customer_id bigint, action_type string, timestamp timestamp_ntz, "
        "amount decimal(18,2), fund_code string"
    ),
    "monthly_outstandings": _schema(
        "customer_id bigint, year_month string, account_volume decimal(18,2), "
        "fund_volume decimal(18,2)"
    ),
    "daily_outstandings": _schema(
        "customer_id bigint, account_volume decimal(18,2), fund_volume decimal(18,2), date date"
    ),
    "monthly_outstanding_funds": _schema(
        "customer_id bigint, year_month string, fund_code string, size decimal(28,2)"
    ),
    "member_details": _schema(
        "customer_id bigint, birth_year int, occupation string, education string, "
        "interest_preference string, registration_time timestamp_ntz, "
        "account_ready_time timestamp_ntz"
    ),
    "bias_results": _schema("customer_id bigint, result_key string, result_value string"),
    "fund_details": _schema("code string, risk_value int, category string, asset_class string"),
    "popular_funds": _schema("day date, fund_code string"),
    "digital_actions": _schema(
        "customer_id bigint, view_name string, action string, details string, "
        "event_time timestamp_ntz"
    ),
    "upload_log": _schema("log_date date, table_name string, row_count bigint"),
}

# Tables that grow by loads, each load partitioned by the day of this column.
DAY = "event_day"
DAY_OF = {
    "digital_actions": "event_time",
    "actions": "timestamp",
    "fund_actions": "timestamp",
    "daily_outstandings": "date",
}

# Tables rewritten month by month.
BY_MONTH = ("monthly_outstandings", "monthly_outstanding_funds")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; extra columns fall away."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
