"""The result tables, planned from landed tables.

``landed`` is anything with the landed tables as attributes: ``Landing`` for one
lazy plan from the sources, ``Warehouse`` for tables written by earlier runs.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope import schemas
from folioscope.operators import features, fund_monthly, monthly, paths, static


class OfMonths:
    """Landed tables cut to some months (``yyyy/MM``); tables without a month stay whole."""

    def __init__(self, landed, months):
        self.landed, self.months = landed, list(months)

    def month(self, name: str) -> Column | None:
        if name in schemas.DAY_OF:
            return F.date_format(schemas.DAY_OF[name], "yyyy/MM")
        return F.col("year_month") if name in schemas.BY_MONTH else None

    def rows(self, name: str) -> DataFrame:
        return getattr(self.landed, name)

    def __getattr__(self, name: str) -> DataFrame:
        month, rows = self.month(name), self.rows(name)
        return rows if month is None else rows.filter(month.isin(self.months))


def summary_static(landed, as_of) -> DataFrame:
    return static.summary_static(landed.member_details, landed.bias_results, as_of)


def summary_year_month(landed) -> DataFrame:
    return monthly.summary_year_month(
        landed.monthly_outstandings,
        landed.actions,
        landed.fund_actions,
        landed.daily_outstandings,
        landed.monthly_outstanding_funds,
        landed.fund_details,
    )


def summary_year_month_fund(landed) -> DataFrame:
    return fund_monthly.summary_year_month_fund(
        landed.fund_actions, landed.actions, landed.monthly_outstanding_funds
    )


def first_day(as_of: date, months: int = K.LOOKBACK_MONTHS) -> date:
    """The first day paths look back to, as ``add_months`` counts."""
    year, month = divmod(as_of.year * 12 + as_of.month - 1 - months, 12)
    return date(year, month + 1, min(as_of.day, monthrange(year, month + 1)[1]))


def digital_process(landed, as_of, legacy_clock: bool = False) -> DataFrame:
    since = first_day(as_of)
    formatted = paths.digital_formatted(landed.since("digital_actions", since), as_of)
    actions = landed.since("actions", since)
    return paths.digital_process(formatted, actions, as_of, legacy_clock=legacy_clock)


def feature_updates(landed, as_of, legacy_interest: bool = False) -> DataFrame:
    return features.feature_updates(
        landed.digital_actions,
        landed.actions,
        landed.fund_actions,
        landed.member_details,
        landed.bias_results,
        landed.monthly_outstanding_funds,
        landed.fund_details,
        landed.popular_funds,
        as_of,
        legacy_interest,
    )


def arketip(landed, as_of, previous: DataFrame | None = None) -> DataFrame:
    """The feature matrix, laid over an earlier one if there is one."""
    updates = feature_updates(landed, as_of)
    if previous is None:
        return features.feature_defaults(updates)
    return features.feature_merge(updates, previous)
