"""The action log: one row per thing a customer did."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions import times

TRANSACTION_LABELS = tuple(K.TX_LABELS.values()) + tuple(K.AUTO_LABELS.values())
MEMBER_LABELS = (K.DOWNLOAD, K.REGISTER, K.PROFILE_PICTURE)


def _log(rows: DataFrame, label: str, at: str, amount: str = "0", fund: str | None = None):
    """The five columns of the log; no amount reads 0 and no fund reads 'NA'."""
    return rows.selectExpr(
        "customer_id",
        f"{label} AS action_type",
        f"CAST({at} AS TIMESTAMP_NTZ) AS timestamp",
        f"CAST({amount} AS DECIMAL(18,2)) AS amount",
        f"{fund or repr(K.NO_FUND)} AS fund_code",
    )


def _label_of(labels: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{tx_type}' THEN '{label}'" for tx_type, label in labels.items())
    return f"CASE tx_type {cases} END" if cases else "CAST(NULL AS STRING)"


def transaction_actions(
    transactions: DataFrame,
    account_ids: DataFrame,
    funds: DataFrame,
    start,
    end,
    labels: Collection[str] = TRANSACTION_LABELS,
    closed: bool = False,
) -> DataFrame:
    """Cash and fund transactions, read once whatever the number of ``labels``.

    A trade of an autonomous-portfolio fund appears under its plain label and
    again under the autonomous one.
    """
    plain = {t: label for t, label in K.TX_LABELS.items() if label in labels}
    auto = {t: label for t, label in K.AUTO_LABELS.items() if label in labels}
    rows = transactions.filter(
        F.col("tx_type").isin(*(plain.keys() | auto.keys()))
        & times.in_window(F.col("tx_time"), start, end, closed)
    ).select("account_serno", "tx_type", "tx_time", "amount", "fund_code")
    found = [_label_of(plain)]
    if auto:
        auto_funds = (
            funds.filter(f"asset_class = '{K.AUTO_ASSET_CLASS}'")
            .selectExpr("code AS fund_code", "true AS is_auto")
            .distinct()
        )
        rows = rows.join(auto_funds, "fund_code", "left")
        found.append(f"CASE WHEN is_auto THEN {_label_of(auto)} END")
    labelled = rows.selectExpr(
        "account_serno",
        "tx_type",
        "tx_time",
        "amount",
        "fund_code",
        f"explode(filter(array({', '.join(found)}), x -> x IS NOT NULL)) AS label",
    )
    funded = ", ".join(f"'{t}'" for t in K.FUND_TX_TYPES)
    fund = f"CASE WHEN tx_type IN ({funded}) THEN fund_code ELSE '{K.NO_FUND}' END"
    return _log(labelled.join(account_ids, "account_serno"), "label", "tx_time", "amount", fund)


def member_actions(
    members: DataFrame, ids: DataFrame, now, labels: Collection[str] = MEMBER_LABELS
) -> DataFrame:
    """Download, registration and profile picture, from one read of the members."""
    entries = {
        K.DOWNLOAD: ("true", "creation_time"),
        K.REGISTER: ("true", "registration_time"),
        K.PROFILE_PICTURE: ("profile_picture IS NOT NULL", f"TIMESTAMP_NTZ '{now}'"),
    }
    listed = ", ".join(
        f"CASE WHEN {present} THEN struct('{label}' AS label, CAST({at} AS TIMESTAMP_NTZ) AS at) END"
        for label, (present, at) in entries.items()
        if label in labels
    )
    found = members.selectExpr(
        "serno AS member_serno", f"explode(filter(array({listed}), x -> x IS NOT NULL)) AS entry"
    )
    return _log(found.join(ids, "member_serno"), "entry.label", "entry.at")


def order_cancels(fund_orders: DataFrame, portfolio_ids: DataFrame) -> DataFrame:
    """Fund orders the customer cancelled."""
    cancelled = (
        fund_orders.filter("status = 'C' AND cancelled_by = 'U'")
        .select("portfolio_serno", "cancel_time", "amount", "fund_code")
        .join(portfolio_ids, "portfolio_serno")
    )
    return _log(cancelled, f"'{K.ORDER_CANCEL}'", "cancel_time", "amount", "fund_code")


def new_portfolios(portfolios: DataFrame, account_ids: DataFrame) -> DataFrame:
    """Every movable portfolio of a member but the first (the lowest serno)."""
    movable = (
        portfolios.filter("type = 'movable'")
        .select("serno", "account_serno", "create_date")
        .join(account_ids, "account_serno")
    )
    first = movable.groupBy("member_serno").agg(F.min("serno").alias("serno"))
    later = movable.join(first, ["member_serno", "serno"], "left_anti")
    return _log(later, f"'{K.NEW_PORTFOLIO}'", "create_date")


def multiple_ibans(ibans: DataFrame, ids: DataFrame, now) -> DataFrame:
    """Members with more than one recorded bank account."""
    several = ibans.groupBy("member_serno").count().filter("count > 1")
    return _log(
        several.join(ids, "member_serno"), f"'{K.MULTI_IBAN}'", f"TIMESTAMP_NTZ '{now}'"
    )


def all_actions(*parts: DataFrame) -> DataFrame:
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log
