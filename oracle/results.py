"""The result of every query as SQL over the landed tables."""

from __future__ import annotations

import re

from folioscope import constants as K
from folioscope.operators.features import FEATURES, NO_DEFAULT
from oracle.landed import TS, landed_ctes, quoted, source_ctes

AS_OF, START, END = "2024-01-31", "2023-11-01", "2024-02-01"
MID_AS_OF, MID = "2024-01-15", "2024-01-16"
SEED = 42
KEYWORD = "folioscope"

LOG_COLUMNS = f"customer_id, action_type, {TS}, CAST(amount AS DOUBLE) AS amount, fund_code"


def _months(table: str, at: str, measures: str, where: str = "TRUE", extra: str = "") -> str:
    """Measures per customer and calendar month."""
    return f"""SELECT customer_id AS cust_id, CAST(year({at}) AS INT) AS year,
 CAST(month({at}) AS INT) AS month{extra}, {measures}
 FROM {table} WHERE {at} IS NOT NULL AND {where} GROUP BY ALL"""


def _year_months(table: str, measures: str, extra: str = "") -> str:
    """The same for tables that name the month in a text."""
    return f"""SELECT customer_id AS cust_id, CAST(split_part(year_month, '/', 1) AS INT) AS year,
 CAST(split_part(year_month, '/', 2) AS INT) AS month{extra}, {measures}
 FROM {table} WHERE regexp_full_match(year_month, '[0-9]{{4}}/[0-9]{{2}}') GROUP BY ALL"""


def _upper(body: str, **names: str) -> str:
    """A body under the analysts' upper-case column names."""
    columns = ", ".join(f"{old} AS {new}" for old, new in names.items())
    return (
        f"SELECT cust_id AS CUST_ID, year AS \"YEAR\", month AS \"MONTH\", {columns} FROM ({body}) b"
    )


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


HOUR = f"hour({TS})"
HOURS = {name: f"{HOUR} BETWEEN {a} AND {b}" for name, (a, b) in K.HOUR_BUCKETS.items()}
HOURS[K.NIGHT] = f"({HOUR} < 5 OR {HOUR} = 23)"
HOUR_COUNTS = ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in HOURS.items())
HOUR_TOTAL = " + ".join(HOURS)


def monthly_ctes() -> dict[str, str]:
    traded = f"action_type IN ('{K.FUND_BUY}', '{K.FUND_SELL}')"
    opened = "(SELECT a.*, d.risk_value FROM fund_actions a JOIN fund_details d ON d.code = a.fund_code WHERE a.action_type = 'open') o"
    held = "(SELECT h.*, d.risk_value FROM monthly_outstanding_funds h JOIN fund_details d ON d.code = h.fund_code) o"
    return {
        "ym_volumes": _year_months(
            "monthly_outstandings",
            f"{_d('sum(fund_volume)')} AS fund_volume, {_d('sum(account_volume)')} AS account_volume",
        ),
        "ym_transaction_volume": _months(
            "actions",
            TS,
            f"coalesce({_d(f'sum(amount) FILTER (WHERE {traded})')}, 0.0) AS transaction_volume",
        ),
        "ym_activity_count": _months("actions", TS, "count(*) AS activity_score"),
        "ym_interested_fund_count": _months(
            "fund_actions", TS, "count(DISTINCT fund_code) AS interested_fund_count"
        ),
        "ym_average_outstanding": _months(
            "daily_outstandings",
            '"date"',
            f"{_d('sum(account_volume)')} / count(account_volume) AS average_outstanding",
        ),
        "ym_outstanding_trend": _months(
            "daily_outstandings",
            '"date"',
            "CAST(max(account_volume) > min(account_volume) AS INT) AS outstanding_trend",
        ),
        "ym_interested_fund_risk": _months(
            opened, TS, f"{_d('sum(risk_value)')} / count(*) AS interested_fund_risk"
        ),
        "ym_owned_fund_count": _year_months(
            "monthly_outstanding_funds", "count(DISTINCT fund_code) AS owned_fund_count"
        ),
        "ym_owned_fund_risk": _year_months(
            held, f"{_d('sum(risk_value * size)')} / {_d('sum(size)')} AS owned_fund_risk"
        ),
        "ym_hourly_activity": _months("actions", TS, HOUR_COUNTS),
        "fund_clicks": _months(
            "fund_actions", TS, "count(*) AS fund_clicks", extra=", fund_code"
        ),
        "fund_transaction_volume": _months(
            "actions",
            TS,
            f"{_d('sum(amount)')} AS fund_transaction_volume",
            "fund_code IS NOT NULL",
            ", fund_code",
        ),
        "fund_outstanding": _year_months(
            "monthly_outstanding_funds", f"{_d('sum(size)')} AS fund_outstanding", ", fund_code"
        ),
    }


def path_ctes() -> dict[str, str]:
    words = " OR ".join(f"event_field ILIKE '%{w}%'" for w in K.IGNORED_WORDS)
    ends = ", ".join(
        f"({seq}, 'last', '{v}', '{a}', '{d}', '{v} - {a} - {d}')"
        for seq, v, a, d in K.CONVERSION_EVENTS
    )
    fixed = ", ".join(f"('{name}')" for name in K.IGNORED_EVENTS)
    since = f"(DATE '{AS_OF}' - INTERVAL {K.LOOKBACK_MONTHS} MONTH)"
    return {
        "digital_formatted": f"""SELECT customer_id, view_name, action, details,
 view_name || ' - ' || action || ' - ' || split_part(details, ',', 1) AS event_field,
 event_time AS converted_timestamp, CAST(year(event_time) AS INT) AS year,
 CAST(month(event_time) AS INT) AS month, split_part(details, ',', 1) AS details_bef_comma,
 split_part(details, ',', 2) AS details_aft_comma, '' AS event_data
 FROM digital_actions WHERE event_time >= {since}""",
        "conversion_events": f"""SELECT CAST(seq AS INT) AS seq, direction, view_name, action, event_details, event_field
 FROM (VALUES {ends}) v(seq, direction, view_name, action, event_details, event_field)""",
        "ignored_events": f"""SELECT ignored_event_field FROM (VALUES {fixed}) v(ignored_event_field)
 UNION ALL SELECT DISTINCT event_field FROM digital_formatted WHERE {words}""",
        "digital_process": f"""SELECT customer_id, year, month, 'digital' AS source, view_name, action, details,
 event_field, event_data, details_bef_comma, details_aft_comma, '' AS event_data_text,
 CAST(0 AS BIGINT) AS event_data_num, converted_timestamp FROM digital_formatted f
 WHERE NOT EXISTS (SELECT 1 FROM ignored_events i WHERE i.ignored_event_field = f.event_field)
 UNION ALL SELECT customer_id, CAST(year({TS}) AS INT), CAST(month({TS}) AS INT), 'transaction', '', '',
 action_type, action_type, '', '', '', fund_code, CAST(round(amount) AS BIGINT), {TS}
 FROM actions WHERE CAST({TS} AS DATE) >= {since}""",
        "conversion_occurrences": """SELECT c.seq, c.direction, p.customer_id, p.converted_timestamp, p.event_field,
 p.event_data_text, p.event_data_num FROM digital_process p JOIN conversion_events c ON c.event_field = p.event_field""",
        "prior_events": """SELECT p.customer_id, c.seq, p.converted_timestamp AS event_time, p.event_field AS event_type
 FROM digital_process p CROSS JOIN conversion_events c WHERE EXISTS (SELECT 1 FROM conversion_occurrences o
 WHERE o.customer_id = p.customer_id AND o.seq = c.seq AND o.converted_timestamp > p.converted_timestamp)""",
        "event_prev": """SELECT customer_id, converted_timestamp AS event_time, event_field AS event_type,
 lag(event_field) OVER (PARTITION BY customer_id ORDER BY converted_timestamp, event_field) AS prev_event
 FROM digital_process""",
        "event_groups": """SELECT customer_id, seq, event_time, event_type, is_new_group,
 CAST(sum(is_new_group) OVER (PARTITION BY customer_id, seq ORDER BY event_time) AS BIGINT) AS event_group
 FROM (SELECT e.customer_id, c.seq, e.event_time, e.event_type,
 CAST(e.prev_event IS DISTINCT FROM e.event_type AS INT) AS is_new_group
 FROM event_prev e CROSS JOIN conversion_events c WHERE EXISTS (SELECT 1 FROM conversion_occurrences o
 WHERE o.customer_id = e.customer_id AND o.seq = c.seq AND o.converted_timestamp > e.event_time)) g""",
        "latest_per_event_type": """SELECT customer_id, seq, event_type, max(event_time) AS event_time
 FROM prior_events GROUP BY ALL""",
        # Every pair of an event and a later conversion, ranked as pairs.
        "path_pairs": """SELECT p.customer_id, o.seq, p.event_field AS event_type, p.converted_timestamp AS event_time
 FROM digital_process p JOIN conversion_occurrences o
 ON o.customer_id = p.customer_id AND p.converted_timestamp < o.converted_timestamp
 QUALIFY row_number() OVER (PARTITION BY p.customer_id, o.seq, p.event_field ORDER BY p.converted_timestamp DESC) = 1""",
        "last_3_events": """SELECT customer_id, seq, event_type, event_time, CAST(rank_ AS INT) AS event_rank FROM (
 SELECT *, row_number() OVER (PARTITION BY customer_id, seq ORDER BY event_time DESC, event_type) AS rank_
 FROM path_pairs) r WHERE rank_ <= 3""",
        "out_path_4_events": """SELECT o.seq, o.direction, o.customer_id AS cust_id,
 o.converted_timestamp AS last_event_timestamp,
 (SELECT event_type FROM last_3_events l WHERE l.customer_id = o.customer_id AND l.seq = o.seq AND event_rank = 1) AS event_1,
 (SELECT event_type FROM last_3_events l WHERE l.customer_id = o.customer_id AND l.seq = o.seq AND event_rank = 2) AS event_2,
 (SELECT event_type FROM last_3_events l WHERE l.customer_id = o.customer_id AND l.seq = o.seq AND event_rank = 3) AS event_3,
 o.event_field AS event_4, o.event_data_text AS event_4_data_text, o.event_data_num AS event_4_data_num
 FROM conversion_occurrences o
 WHERE EXISTS (SELECT 1 FROM last_3_events l WHERE l.customer_id = o.customer_id AND l.seq = o.seq)""",
    }


def _event_condition(name: str) -> str:
    rule = K.EVENT_FEATURES[name]
    terms = []
    for key, column in (("view", "view_name"), ("action", "action"), ("details", "details")):
        if key in rule:
            terms.append(f"{column} ILIKE '%{rule[key]}%'")
        if f"{key}_is" in rule:
            terms.append(f"{column} = '{rule[f'{key}_is']}'")
    if rule.get("night"):
        terms.append("hour(event_time) NOT BETWEEN 6 AND 21")
    return " AND ".join(terms)


def feature_ctes(as_of: str, s: str = "") -> dict[str, str]:
    """One table per feature with the customers it was measured for."""

    def flag(name: str, table: str, condition: str) -> str:
        return f"SELECT DISTINCT customer_id, CAST(1 AS INT) AS {name} FROM {table}{s} WHERE {condition}"

    def share(name: str, table: str, weight: str, condition: str) -> str:
        chosen = f"SELECT code FROM fund_details WHERE asset_class = '{K.PARTICIPATION_ASSET_CLASS}'"
        return f"""SELECT customer_id, CAST(1 AS INT) AS {name} FROM {table}{s} WHERE {condition} GROUP BY customer_id
 HAVING sum({weight}) > 0
 AND {_d(f"coalesce(sum({weight}) FILTER (WHERE fund_code IN ({chosen})), 0)")} / {_d(f"sum({weight})")} > {K.PARTICIPATION_SHARE}"""

    bought = f"action_type = '{K.FUND_BUY}' AND fund_code IS NOT NULL"
    age = f"year(DATE '{as_of}') - birth_year"
    tables = {
        "dya_score": flag("dya_score", "bias_results", f"result_key = '{K.BIT_KEY}'"),
        "has_account_ready": flag(
            "has_account_ready", "member_details", "account_ready_time IS NOT NULL"
        ),
        "otonombuy": f"""SELECT customer_id, CAST(1 AS INT) AS otonombuy FROM (
 SELECT d.customer_id FROM digital_actions{s} d JOIN actions{s} a ON a.customer_id = d.customer_id
 AND a.{TS} >= d.event_time AND a.{TS} <= d.event_time + INTERVAL {K.STRATEGY_DAYS} DAY
 WHERE d.details ILIKE '%{K.STRATEGY_WORD}%' AND a.action_type ILIKE '%{K.FUND_BUY}%') p
 GROUP BY customer_id HAVING count(*) > 1""",
        "age_28_48": flag(
            "age_28_48", "member_details", f"{age} >= {K.AGE_FROM} AND {age} <= {K.AGE_TO}"
        ),
        "katilim_yatirim": share("katilim_yatirim", "monthly_outstanding_funds", "size", "TRUE"),
        "faiz_okey": flag("faiz_okey", "member_details", "interest_preference = 'Y'"),
        "katilim_ilgi": share("katilim_ilgi", "fund_actions", "1", "action_type = 'open'"),
        "popular_fund_ratio": f"""SELECT customer_id, coalesce({_d(f"count(*) FILTER (WHERE {bought} AND fund_code IN (SELECT fund_code FROM popular_funds))")}
 / nullif(count(*) FILTER (WHERE {bought}), 0), 0.0) AS popular_fund_ratio FROM actions{s} GROUP BY customer_id""",
        "yeni_portfoy": flag("yeni_portfoy", "actions", f"action_type = '{K.NEW_PORTFOLIO}'"),
        "birden_fazla_banka_hesabi": flag(
            "birden_fazla_banka_hesabi", "actions", f"action_type = '{K.MULTI_IBAN}'"
        ),
    }
    for name, rule in K.EVENT_FEATURES.items():
        if rule["kind"] == "flag":
            tables[name] = flag(name, "digital_actions", _event_condition(name))
        else:
            tables[name] = f"""SELECT customer_id, count(*) AS {name} FROM digital_actions{s}
 WHERE {_event_condition(name)} GROUP BY customer_id"""
    ctes = {f"f_{name}{s}": tables[name] for name in FEATURES}
    ctes[f"feature_population{s}"] = f"""SELECT customer_id FROM digital_actions{s}
 UNION SELECT customer_id FROM actions{s} UNION SELECT customer_id FROM member_details{s}"""
    joins = " ".join(f"LEFT JOIN f_{name}{s} USING (customer_id)" for name in FEATURES)
    ctes[f"feature_updates{s}"] = f"SELECT * FROM feature_population{s} {joins}"
    return ctes


def _filled(value) -> str:
    """All feature columns by ``value(name)``, with 0 for what was never measured."""
    return ", ".join(
        f"{value(n)} AS {n}" if n in NO_DEFAULT else f"coalesce({value(n)}, 0) AS {n}"
        for n in FEATURES
    )


def _log(label: str) -> str:
    return f"SELECT {LOG_COLUMNS} FROM actions WHERE action_type = '{label}'"


ACTION_KEYS = {
    "act_download": K.DOWNLOAD,
    "act_register": K.REGISTER,
    "act_cash_in": K.CASH_IN,
    "act_cash_out": K.CASH_OUT,
    "act_fund_buy": K.FUND_BUY,
    "act_fund_sell": K.FUND_SELL,
    "act_auto_buy": K.AUTO_BUY,
    "act_auto_sell": K.AUTO_SELL,
    "act_order_cancel": K.ORDER_CANCEL,
    "act_new_portfolio": K.NEW_PORTFOLIO,
    "act_profile_picture": K.PROFILE_PICTURE,
    "act_multi_iban": K.MULTI_IBAN,
}


def _extraction() -> dict[str, str]:
    waiting = """status = 'A' AND account_type = 'named' AND registration_time IS NOT NULL
 AND mobile_number_verified = '1' AND account_ready_time IS NULL"""
    shown = "coalesce(strftime({0}, '%H.%M-%d.%m.%y'), 'N/A') AS {0}"
    return {
        "source_scan": f"""SELECT serno, account_serno, tx_type, tx_time, {_d('amount')} AS amount FROM transactions
 WHERE tx_time >= TIMESTAMP '{MID}' AND tx_time < TIMESTAMP '{END}'""",
        "eligible_members": f"""SELECT serno FROM members WHERE {waiting} UNION SELECT serno FROM members
 WHERE status = 'A' AND mobile_number_verified = '1' AND account_ready_time IS NOT NULL""",
        "member_by_id": "SELECT serno FROM members WHERE serno = 1002",
        "active_account_members": "SELECT member_serno FROM accounts WHERE status = 'A' AND member_serno = 1010",
        "members_without_account_sample": f"""SELECT serno FROM members WHERE {waiting}
 ORDER BY md5('{SEED}:' || CAST(serno AS VARCHAR)), serno LIMIT {K.SAMPLE_SIZE}""",
        "digital_actions": "SELECT * FROM digital_actions",
        "fund_actions": "SELECT * FROM fund_actions",
        "monthly_outstandings": f"SELECT customer_id, year_month, {_d('account_volume')} AS account_volume, {_d('fund_volume')} AS fund_volume FROM monthly_outstandings",
        "monthly_outstanding_funds": f"SELECT customer_id, year_month, fund_code, {_d('size')} AS size FROM monthly_outstanding_funds",
        "daily_outstandings": f'SELECT customer_id, {_d("account_volume")} AS account_volume, {_d("fund_volume")} AS fund_volume, "date" FROM daily_outstandings',
        "pseudonymize": """SELECT coalesce(x.random_serno, a.member_serno) AS customer_id, a.serno AS account_serno
 FROM accounts a LEFT JOIN serno_mapping x ON x.actual_serno = a.member_serno""",
        "pseudonymize_strict": """SELECT x.random_serno AS customer_id, a.serno AS account_serno
 FROM accounts a JOIN serno_mapping x ON x.actual_serno = a.member_serno""",
        "id_collisions": """SELECT CASE WHEN x.actual_serno IS NULL THEN i.member_serno
 WHEN x.actual_serno % 50 = 0 THEN x.actual_serno + 49 ELSE x.random_serno END AS customer_id
 FROM ids i LEFT JOIN serno_mapping x ON x.actual_serno = i.member_serno GROUP BY 1 HAVING count(*) > 1""",
        "member_details": "SELECT * FROM member_details",
        "bias_results": "SELECT * FROM bias_results",
        "fund_details": "SELECT * FROM fund_details",
        "popular_funds": "SELECT * FROM popular_funds",
        "recorded_ibans": "SELECT member_serno, status, last_used_date FROM recorded_ibans",
        "display_timestamp": f"""SELECT customer_id, birth_year, occupation, education, interest_preference,
 {shown.format('registration_time')}, {shown.format('account_ready_time')} FROM member_details""",
        "incremental_slice": f"""SELECT event_id, member_serno, view_name, activity, details, client_time, server_time FROM activity
 WHERE server_time >= TIMESTAMP '{MID}' AND server_time < TIMESTAMP '{AS_OF}'""",
        "write_table": f"SELECT {LOG_COLUMNS} FROM actions",
        "upload_log": f"""SELECT log_date, table_name, count(*) AS row_count FROM (
 SELECT CAST(event_time AS DATE) AS log_date, 'digital_actions' AS table_name FROM digital_actions
 UNION ALL SELECT CAST({TS} AS DATE), 'fund_actions' FROM fund_actions) t GROUP BY ALL""",
        "row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
            for t in ("digital_actions", "fund_actions", "actions", "member_details")
        ),
        **{key: _log(label) for key, label in ACTION_KEYS.items()},
        "actions_all": f"SELECT {LOG_COLUMNS} FROM actions",
    }


def _static() -> dict[str, str]:
    years = f"(year(DATE '{AS_OF}') - birth_year)"
    ages = f"CASE WHEN {years} > 40 OR birth_year IS NULL THEN '40+' WHEN {years} > 25 THEN '26-40' ELSE '0-25' END"
    profile = {
        "occupation": "OCCUPATION",
        "education": "EDUCATION",
        "registration_time": "REGISTRATION_DATE",
        "account_ready_time": "ACCOUNT_READY_DATE",
    }
    return {
        "age_range": f"SELECT customer_id AS CUST_ID, {ages} AS AGE_RANGE FROM member_details",
        "survey_risk": f"SELECT customer_id AS CUST_ID, result_value AS SURVEY_RISK FROM bias_results WHERE result_key = '{K.RISK_KEY}'",
        "bit_score": f"SELECT customer_id AS CUST_ID, result_value AS BIT_SCORE FROM bias_results WHERE result_key = '{K.BIT_KEY}'",
        "summary_static": f"""SELECT d.customer_id AS cust_id, {ages} AS age_range, occupation AS job, education,
 interest_preference, r.result_value AS survey_risk, b.result_value AS bit_score,
 registration_time AS reg_date, account_ready_time AS account_ready_date FROM member_details d
 LEFT JOIN (SELECT * FROM bias_results WHERE result_key = '{K.RISK_KEY}') r ON r.customer_id = d.customer_id
 LEFT JOIN (SELECT * FROM bias_results WHERE result_key = '{K.BIT_KEY}') b ON b.customer_id = d.customer_id""",
        "profile_columns": "SELECT customer_id AS CUST_ID, "
        + ", ".join(f"{c} AS {n}" for c, n in profile.items())
        + " FROM member_details",
        **{
            f"profile_{c}": f"SELECT customer_id AS CUST_ID, {c} AS {n} FROM member_details"
            for c, n in profile.items()
        },
    }


def _monthly() -> dict[str, str]:
    ym = list(monthly_ctes())
    joined = " ".join(
        f"LEFT JOIN {name} USING (cust_id, year, month)" for name in ym if name.startswith("ym_") and name != "ym_volumes"
    )
    shares = ", ".join(
        f"{_d(f'round(CAST(100 * {n} AS DECIMAL(18,6)) / nullif({HOUR_TOTAL}, 0), 2)')} AS {n}_activity_percentage"
        for n in HOURS
    )
    keys = "(cust_id, year, month, fund_code)"
    return {
        **{name: f"SELECT * FROM {name}" for name in ym},
        "summary_year_month": f"""SELECT cust_id, year, month, fund_volume / nullif(account_volume, 0) AS fund_balance_ratio,
 average_outstanding, outstanding_trend, interested_fund_count, interested_fund_risk, transaction_volume,
 owned_fund_count, owned_fund_risk, activity_score, {shares} FROM ym_volumes {joined}""",
        "summary_year_month_fund": f"""SELECT cust_id, year, month, fund_code, fund_clicks, fund_outstanding, fund_transaction_volume
 FROM fund_clicks FULL JOIN fund_transaction_volume USING {keys} FULL JOIN fund_outstanding USING {keys}""",
    }


def _features() -> dict[str, str]:
    # What the second window measured, else what the first one did.
    def either(name: str) -> str:
        return f"coalesce(u.{name}, o.{name})"

    return {
        **{name: f"SELECT * FROM f_{name}" for name in FEATURES},
        "feature_population": "SELECT customer_id FROM feature_population",
        "feature_defaults": f"""SELECT p.customer_id, {_filled(lambda name: f"u.{name}")}
 FROM feature_population p LEFT JOIN feature_updates u ON FALSE""",
        "feature_merge": f"""SELECT coalesce(u.customer_id, o.customer_id) AS customer_id, {_filled(either)}
 FROM feature_updates_new u FULL JOIN feature_updates_old o ON o.customer_id = u.customer_id""",
        "arketip": f"SELECT customer_id, {_filled(str)} FROM feature_updates",
    }


def _metrics() -> dict[str, str]:
    per_month = _months("actions", TS, "count(*) AS n")
    opens = "(SELECT a.*, d.risk_value FROM fund_actions a LEFT JOIN fund_details d ON d.code = a.fund_code WHERE a.action_type = 'open') o"
    held = "(SELECT h.*, d.risk_value FROM monthly_outstanding_funds h LEFT JOIN fund_details d ON d.code = h.fund_code) o"
    traded = f"action_type IN ('{K.FUND_BUY}', '{K.FUND_SELL}')"
    shares = ", ".join(
        f"printf('%.2f%%', {_d(n)} / ({HOUR_TOTAL}) * 100) AS {n.upper()}_ACTIVITY_PERCENTAGE"
        for n in HOURS
    )
    hours = _months("actions", TS, HOUR_COUNTS)
    # Without nights, so that one part of the day is absent everywhere.
    daytime = _months("actions", TS, HOUR_COUNTS, f"{HOUR} BETWEEN 5 AND 22")
    filled = ", ".join(
        f"coalesce(printf('%.2f%%', {_d(n)} / ({HOUR_TOTAL}) * 100), '0%') AS {n.upper()}_ACTIVITY_PERCENTAGE"
        for n in HOURS
    )
    fields = ["customer_id", "action_type", "fund_code", TS]
    row = " || chr(31) || ".join([f"'{KEYWORD}'", *(f"CAST({f} AS VARCHAR)" for f in fields)])
    digest_sums = ", ".join(
        f"CAST(sum(CAST(CAST('0x' || substring(digest, {at}, 8) AS BIGINT) AS HUGEINT)) AS VARCHAR)"
        for at in range(1, 65, 8)
    )

    def months(n: str, name: str, body: str) -> str:
        return _upper(body, **{n: name})

    return {
        "activity_score_scaled": f"""SELECT cust_id AS CUST_ID, year AS "YEAR", month AS "MONTH",
 round_even({_d('n - min(n) OVER ()')} / (max(n) OVER () - min(n) OVER ()) * 100 * 100, 0) / 100 AS ACTIVITY_SCORE
 FROM ({per_month}) b""",
        "hour_bucket_pct": f"""SELECT cust_id AS CUST_ID, year AS "YEAR", month AS "MONTH", {shares} FROM ({hours}) b""",
        "hour_bucket_pct_filled": f"""SELECT c.cust_id AS CUST_ID, y.year AS "YEAR", m.month AS "MONTH", {filled}
 FROM (SELECT DISTINCT cust_id FROM ({daytime}) a) c CROSS JOIN (SELECT DISTINCT year FROM ({daytime}) a) y
 CROSS JOIN (SELECT DISTINCT month FROM ({daytime}) a) m LEFT JOIN ({daytime}) b
 ON b.cust_id = c.cust_id AND b.year = y.year AND b.month = m.month""",
        "fund_balance_ratio_rows": f"""SELECT customer_id AS CUST_ID, CAST(left(year_month, 4) AS INT) AS "YEAR",
 CAST(right(year_month, 2) AS INT) AS "MONTH", {_d('fund_volume')} / {_d('account_volume')} AS FUND_BALANCE_RATIO
 FROM monthly_outstandings""",
        "fund_clicks_pd": """SELECT cust_id AS CUST_ID, year AS "YEAR", month AS "MONTH", fund_code AS FUND_CODE, fund_clicks AS FUND_CLICKS FROM fund_clicks""",
        "fund_outstanding_rows": f"""SELECT customer_id AS CUST_ID, CAST(left(year_month, 4) AS INT) AS "YEAR",
 CAST(right(year_month, 2) AS INT) AS "MONTH", fund_code AS FUND_CODE, {_d('size')} AS FUND_OUTSTANDING
 FROM monthly_outstanding_funds""",
        "fund_transaction_volume_pd": _upper(
            _months("actions", TS, f"{_d('sum(amount)')} AS v", traded, ", fund_code"),
            fund_code="FUND_CODE",
            v="FUND_TRANSACTION_VOLUME",
        ),
        "interested_fund_count_pd": f"""SELECT CAST(year(viewed) AS INT) AS "YEAR", CAST(month(viewed) AS INT) AS "MONTH",
 action_type AS CUST_ID, count(fund_code) AS INTERESTED_FUND_COUNT
 FROM (SELECT *, {TS} - to_months(CAST(customer_id % 24 AS INT)) AS viewed FROM fund_actions) v
 WHERE action_type = 'open' GROUP BY ALL""",
        "interested_fund_risk_pd": months(
            "v",
            "INTERESTED_FUND_RISK",
            _months(opens, TS, f"round_even({_d('coalesce(sum(risk_value), 0)')} / count(*) * 100, 0) / 100 AS v"),
        ),
        "outstanding_trend_diff": f"""SELECT customer_id AS CUST_ID, CAST(year(day) AS INT) AS "YEAR", CAST(month(day) AS INT) AS "MONTH",
 CAST(sign(sum(step)) AS INT) AS OUTSTANDING_TREND FROM (SELECT customer_id, "date" AS day,
 coalesce(account_volume - lag(account_volume) OVER (PARTITION BY customer_id, year("date"), month("date")
 ORDER BY "date", account_volume, fund_volume), 0) AS step FROM daily_outstandings) s GROUP BY ALL""",
        "owned_fund_count_pd": months(
            "v", "OWNED_FUND_COUNT", _year_months("monthly_outstanding_funds", "count(*) AS v")
        ),
        "owned_fund_risk_pd": months(
            "v",
            "OWNED_FUND_RISK",
            _year_months(
                held,
                f"round_even({_d('coalesce(sum(risk_value * size), 0)')} / {_d('sum(size)')} * 100, 0) / 100 AS v",
            ),
        ),
        "transaction_volume_pd": months(
            "v", "TRANSACTION_VOLUME", _months("actions", TS, f"{_d('sum(amount)')} AS v", traded)
        ),
        "average_outstanding_pd": months(
            "average_outstanding", "AVERAGE_OUTSTANDING", "SELECT * FROM ym_average_outstanding"
        ),
        "table_fingerprint": f"SELECT count(*) AS row_count, concat_ws('-', {digest_sums}) AS fingerprint "
        f"FROM (SELECT sha256({row}) AS digest FROM fund_actions) d",
    }


def ctes() -> dict[str, str]:
    return {
        **source_ctes(),
        **landed_ctes(START, END, AS_OF),
        **landed_ctes(START, MID, MID_AS_OF, "_old"),
        **landed_ctes(MID, END, AS_OF, "_new"),
        **monthly_ctes(),
        **path_ctes(),
        **feature_ctes(AS_OF),
        **feature_ctes(MID_AS_OF, "_old"),
        **feature_ctes(AS_OF, "_new"),
    }


def with_ctes(body: str, known: dict[str, str]) -> str:
    """``body`` behind the tables it mentions, directly or through others."""
    needed: set[str] = set()
    waiting = [body]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        for name in words & known.keys() - needed:
            needed.add(name)
            waiting.append(known[name])
    # A table may only mention earlier ones, so the order of definition is safe.
    parts = ",\n".join(f"{name} AS (\n{known[name]}\n)" for name in known if name in needed)
    return f"WITH {parts}\n{body}" if parts else body


def all_sql() -> dict[str, str]:
    known = ctes()
    bodies = {
        **_extraction(),
        **{name: f"SELECT * FROM {name}" for name in path_ctes() if name != "path_pairs"},
        **_static(),
        **_monthly(),
        **_features(),
        **_metrics(),
    }
    found = {name: with_ctes(body, known) for name, body in bodies.items()}
    # Brought up to date from stored results, these must equal what is built at once.
    built = {
        "out_path_4_events_by_window": "out_path_4_events",
        "summary_year_month_by_month": "summary_year_month",
        "feature_merge_by_bucket": "feature_merge",
    }
    return found | {name: found[whole] for name, whole in built.items()}
