"""The landed tables as SQL over the sample views."""

from __future__ import annotations

from folioscope import constants as K
from folioscope.sources.sample import VIEWS, sql_text

TS = '"timestamp"'


def source_ctes() -> dict[str, str]:
    return {name: sql_text(name) for name in VIEWS}


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def landed_ctes(start: str, end: str, as_of: str, suffix: str = "") -> dict[str, str]:
    """The landed tables of one window; ``suffix`` tells the tables of two windows apart."""
    s = suffix
    tx = f"""SELECT i.customer_id, t.tx_type, t.tx_time, t.amount, t.fund_code, f.asset_class
 FROM transactions t JOIN account_ids{s} i ON i.account_serno = t.account_serno
 LEFT JOIN funds f ON f.code = t.fund_code
 WHERE t.tx_time >= TIMESTAMP '{start}' AND t.tx_time < TIMESTAMP '{end}'"""

    def tx_part(tx_type: str, label: str, auto: bool = False) -> str:
        fund = "fund_code" if tx_type in K.FUND_TX_TYPES else f"'{K.NO_FUND}'"
        only = f" AND asset_class = '{K.AUTO_ASSET_CLASS}'" if auto else ""
        return (
            f"SELECT customer_id, '{label}' AS action_type, tx_time AS {TS}, amount, "
            f"{fund} AS fund_code FROM window_tx{s} WHERE tx_type = '{tx_type}'{only}"
        )

    def snapshot(label: str, at: str, source: str, amount="0", fund=f"'{K.NO_FUND}'") -> str:
        return (
            f"SELECT i.customer_id, '{label}' AS action_type, CAST({at} AS TIMESTAMP) AS {TS}, "
            f"CAST({amount} AS DECIMAL(18,2)) AS amount, {fund} AS fund_code FROM {source}"
        )

    by_member = f"members m JOIN ids{s} i ON i.member_serno = m.serno"
    parts = [tx_part(t, label) for t, label in K.TX_LABELS.items()]
    parts += [tx_part(t, label, auto=True) for t, label in K.AUTO_LABELS.items()]
    parts += [
        snapshot(K.DOWNLOAD, "m.creation_time", by_member),
        snapshot(K.REGISTER, "m.registration_time", by_member),
        snapshot(
            K.PROFILE_PICTURE,
            f"TIMESTAMP '{as_of}'",
            f"{by_member} WHERE m.profile_picture IS NOT NULL",
        ),
        snapshot(
            K.ORDER_CANCEL,
            "o.cancel_time",
            f"fund_orders o JOIN portfolio_ids{s} i ON i.portfolio_serno = o.portfolio_serno"
            " WHERE o.status = 'C' AND o.cancelled_by = 'U'",
            "o.amount",
            "o.fund_code",
        ),
        snapshot(
            K.NEW_PORTFOLIO,
            "i.create_date",
            f"""(SELECT j.customer_id, p.create_date, p.serno,
 min(p.serno) OVER (PARTITION BY j.member_serno) AS first_serno
 FROM portfolios p JOIN account_ids{s} j ON j.account_serno = p.account_serno
 WHERE p.type = 'movable') i WHERE i.serno > i.first_serno""",
        ),
        snapshot(
            K.MULTI_IBAN,
            f"TIMESTAMP '{as_of}'",
            f"""ids{s} i WHERE (SELECT count(*) FROM recorded_ibans r
 WHERE r.member_serno = i.member_serno) >= 2""",
        ),
    ]
    day_window = f"e.currency = 'TRY' AND e.day >= DATE '{start}' AND e.day < DATE '{end}'"
    known = f"{day_window} AND e.day <= DATE '{as_of}'"
    return {
        f"ids{s}": """SELECT m.serno AS member_serno, coalesce(x.random_serno, m.serno) AS customer_id
 FROM members m LEFT JOIN serno_mapping x ON x.actual_serno = m.serno
 WHERE m.status = 'A' AND m.mobile_number_verified = '1' AND (m.account_ready_time IS NOT NULL
 OR (m.account_type = 'named' AND m.registration_time IS NOT NULL))""",
        f"account_ids{s}": f"""SELECT a.serno AS account_serno, i.member_serno, i.customer_id
 FROM accounts a JOIN ids{s} i ON i.member_serno = a.member_serno""",
        f"portfolio_ids{s}": f"""SELECT p.serno AS portfolio_serno, i.member_serno, i.customer_id
 FROM portfolios p JOIN account_ids{s} i ON i.account_serno = p.account_serno""",
        f"digital_actions{s}": f"""SELECT i.customer_id, coalesce(a.view_name, '') AS view_name,
 coalesce(a.activity, '') AS action, coalesce(a.details, '') AS details, a.client_time AS event_time
 FROM activity a JOIN ids{s} i ON i.member_serno = a.member_serno
 WHERE a.server_time >= TIMESTAMP '{start}' AND a.server_time < TIMESTAMP '{end}'""",
        f"fund_actions{s}": f"""SELECT i.customer_id,
 CASE WHEN a.details = 'back' OR a.details LIKE 'back,%' THEN 'back' ELSE 'open' END AS action_type,
 f.code AS fund_code, a.client_time AS {TS}
 FROM activity a JOIN ids{s} i ON i.member_serno = a.member_serno
 JOIN funds f ON f.code = substr(a.details, length(a.details) - 2)
 WHERE a.view_name IN ({quoted(K.FUND_VIEWS)})
 AND a.client_time >= TIMESTAMP '{start}' AND a.client_time < TIMESTAMP '{end}'""",
        f"window_tx{s}": tx,
        f"actions{s}": "\n UNION ALL ".join(parts),
        f"monthly_outstandings{s}": f"""SELECT i.customer_id, strftime(e.day, '%Y/%m') AS year_month,
 e.size AS account_volume, e.movable_size AS fund_volume
 FROM eod_accounts e JOIN account_ids{s} i ON i.account_serno = e.account_serno WHERE {known}
 QUALIFY e.day = max(e.day) OVER (PARTITION BY i.member_serno, strftime(e.day, '%Y/%m'))""",
        f"monthly_outstanding_funds{s}": f"""SELECT customer_id, year_month, fund_code, sum(size) AS size
 FROM (SELECT i.member_serno, i.customer_id, strftime(e.day, '%Y/%m') AS year_month, e.fund_code, e.size
 FROM eod_holdings e JOIN portfolio_ids{s} i ON i.portfolio_serno = e.portfolio_serno WHERE {known}
 QUALIFY e.day = max(e.day) OVER (PARTITION BY i.member_serno, e.fund_code, strftime(e.day, '%Y/%m'))) t
 GROUP BY member_serno, customer_id, year_month, fund_code""",
        f"daily_outstandings{s}": f"""SELECT i.customer_id, e.size AS account_volume,
 e.movable_size AS fund_volume, e.day AS "date"
 FROM eod_accounts e JOIN account_ids{s} i ON i.account_serno = e.account_serno WHERE {day_window}""",
        f"member_details{s}": f"""SELECT i.customer_id, m.birth_year, m.occupation, m.education,
 m.interest_preference, m.registration_time, m.account_ready_time FROM {by_member}""",
        f"bias_results{s}": f"""SELECT i.customer_id, r.result_key, r.result_value
 FROM survey_results r JOIN survey_instances n ON n.serno = r.instance_serno
 JOIN survey_definitions d ON d.serno = n.definition_serno JOIN ids{s} i ON i.member_serno = n.member_serno
 WHERE d.name = '{K.PROFILE_SURVEY}' AND n.completed IS NOT NULL AND r.result_value <> 'false'""",
        f"fund_details{s}": "SELECT code, risk_value, category, asset_class FROM funds",
        f"popular_funds{s}": f"SELECT day, fund_code FROM fund_lists WHERE list_type = '{K.POPULAR_LIST}'",
    }
