"""From source tables to landed tables: who, then what they did and held."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from folioscope.operators import actions, balances, events, members


class Landing:
    """The landed tables as lazy DataFrames; each is planned when first asked for.

    ``ids`` and the tables that map accounts and portfolios to customers are
    joined among themselves first, so each large table meets one narrow side.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        start: date,
        end: date,
        as_of: date,
        strict: bool = False,
        legacy: bool = False,
    ):
        self.sources = sources
        self.start, self.end, self.as_of = start, end, as_of
        self.strict, self.legacy = strict, legacy

    @cached_property
    def ids(self) -> DataFrame:
        return members.customer_ids(
            self.sources["members"], self.sources["serno_mapping"], self.strict
        )

    @cached_property
    def account_ids(self) -> DataFrame:
        return members.account_customers(self.sources["accounts"], self.ids)

    @cached_property
    def portfolio_ids(self) -> DataFrame:
        return members.portfolio_customers(self.sources["portfolios"], self.account_ids)

    def since(self, name: str, first) -> DataFrame:
        """A table whose rows before the day ``first`` are not needed; here it is whole."""
        return getattr(self, name)

    def fix_ids(self) -> None:
        """Compute who is who once, in the checkpoint folder; all tables then read that."""
        self.ids = self.ids.checkpoint()
        self.account_ids = self.account_ids.checkpoint()
        self.portfolio_ids = self.portfolio_ids.checkpoint()

    def share_ids(self, other: Landing) -> None:
        self.ids, self.account_ids = other.ids, other.account_ids
        self.portfolio_ids = other.portfolio_ids

    def share(self, other: Landing) -> None:
        """Take from ``other``, of the same sources, all that hangs on no window."""
        self.share_ids(other)
        self.order_cancels = other.order_cancels

    @cached_property
    def order_cancels(self) -> DataFrame:
        return actions.order_cancels(self.sources["fund_orders"], self.portfolio_ids)

    @cached_property
    def digital_actions(self) -> DataFrame:
        return events.digital_actions(self.sources["activity"], self.ids, self.start, self.end)

    @cached_property
    def fund_actions(self) -> DataFrame:
        return events.fund_actions(
            self.sources["activity"], self.ids, self.sources["funds"], self.start, self.end
        )

    @cached_property
    def window_actions(self) -> DataFrame:
        """The part of the action log that is new in the window."""
        return actions.transaction_actions(
            self.sources["transactions"],
            self.account_ids,
            self.sources["funds"],
            self.start,
            self.end,
        )

    @cached_property
    def snapshot_actions(self) -> DataFrame:
        """The part of the action log that has no window and is replaced by each run."""
        return actions.all_actions(
            actions.member_actions(self.sources["members"], self.ids, self.as_of),
            self.order_cancels,
            actions.new_portfolios(self.sources["portfolios"], self.account_ids),
            actions.multiple_ibans(self.sources["recorded_ibans"], self.ids, self.as_of),
        )

    @cached_property
    def actions(self) -> DataFrame:
        return actions.all_actions(self.window_actions, self.snapshot_actions)

    @cached_property
    def monthly_outstandings(self) -> DataFrame:
        return balances.monthly_outstandings(
            self.sources["eod_accounts"],
            self.account_ids,
            self.start,
            self.end,
            self.as_of,
            self.legacy,
        )

    @cached_property
    def monthly_outstanding_funds(self) -> DataFrame:
        return balances.monthly_outstanding_funds(
            self.sources["eod_holdings"],
            self.portfolio_ids,
            self.start,
            self.end,
            self.as_of,
            self.legacy,
        )

    @cached_property
    def daily_outstandings(self) -> DataFrame:
        return balances.daily_outstandings(
            self.sources["eod_accounts"], self.account_ids, self.start, self.end
        )

    @cached_property
    def member_details(self) -> DataFrame:
        return members.member_details(self.sources["members"], self.ids)

    @cached_property
    def bias_results(self) -> DataFrame:
        return events.bias_results(
            self.sources["survey_results"],
            self.sources["survey_instances"],
            self.sources["survey_definitions"],
            self.ids,
        )

    @cached_property
    def fund_details(self) -> DataFrame:
        return events.fund_details(self.sources["funds"])

    @cached_property
    def popular_funds(self) -> DataFrame:
        return events.popular_funds(self.sources["fund_lists"])
