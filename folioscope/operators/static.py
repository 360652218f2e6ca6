"""Customer attributes that do not change from month to month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions.times import day

# Output name of each profile column.
PROFILE_COLUMNS = {
    "occupation": "OCCUPATION",
    "education": "EDUCATION",
    "registration_time": "REGISTRATION_DATE",
    "account_ready_time": "ACCOUNT_READY_DATE",
}


def age(as_of) -> Column:
    return F.year(day(as_of)) - F.col("birth_year")


def _age_range(as_of) -> Column:
    """Three ranges; an unknown birth year falls in the last one."""
    return F.when(age(as_of) <= 25, "0-25").when(age(as_of) <= 40, "26-40").otherwise("40+")


def age_range(details: DataFrame, as_of) -> DataFrame:
    return details.select(F.col("customer_id").alias("CUST_ID"), _age_range(as_of).alias("AGE_RANGE"))


def survey_answer(bias: DataFrame, key: str, name: str) -> DataFrame:
    return bias.filter(F.col("result_key") == key).select(
        F.col("customer_id").alias("CUST_ID"), F.col("result_value").alias(name)
    )


def survey_risk(bias: DataFrame) -> DataFrame:
    return survey_answer(bias, K.RISK_KEY, "SURVEY_RISK")


def bit_score(bias: DataFrame) -> DataFrame:
    return survey_answer(bias, K.BIT_KEY, "BIT_SCORE")


def profile_column(details: DataFrame, column: str) -> DataFrame:
    return details.select(
        F.col("customer_id").alias("CUST_ID"), F.col(column).alias(PROFILE_COLUMNS[column])
    )


def profile_columns(details: DataFrame) -> DataFrame:
    return details.select(
        F.col("customer_id").alias("CUST_ID"),
        *[F.col(column).alias(name) for column, name in PROFILE_COLUMNS.items()],
    )


def summary_static(details: DataFrame, bias: DataFrame, as_of) -> DataFrame:
    """One row per member and pair of survey answers (repeated answers repeat the row)."""
    risk = survey_risk(bias).withColumnsRenamed({"CUST_ID": "customer_id", "SURVEY_RISK": "survey_risk"})
    bit = bit_score(bias).withColumnsRenamed({"CUST_ID": "customer_id", "BIT_SCORE": "bit_score"})
    return (
        details.join(risk, "customer_id", "left")
        .join(bit, "customer_id", "left")
        .select(
            F.col("customer_id").alias("cust_id"),
            _age_range(as_of).alias("age_range"),
            F.col("occupation").alias("job"),
            "education",
            "interest_preference",
            "survey_risk",
            "bit_score",
            F.col("registration_time").alias("reg_date"),
            F.col("account_ready_time").alias("account_ready_date"),
        )
    )
