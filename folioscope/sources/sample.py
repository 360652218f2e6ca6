"""The source tables, derived from the generated test tables.

The texts run in Spark and, for checking, in another SQL engine; only zone-free
timestamp literals (``{ts}``), literal lists (``{pick_...}``) and fund codes
(``CODE[number]``) are spelled differently.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("customer", "orders", "lineitem", "part", "events")

# The catalogue of app events (view, action, details).
EVENT_CATALOGUE = (
    ("account", "click", "deposit"),
    ("account", "click", "openAccount"),
    ("moneyTransfer", "click", "addBankAccount"),
    ("fundsList", "click", "open"),
    ("fundMarket", "click", "open"),
    ("fundDetails", "click", "open"),
    ("fundDetails", "click", "back"),
    ("fundsList", "click", "ChangeSortDirection"),
    ("settings", "open", "main"),
    ("settings", "click", "Çıkış Yap"),
    ("besSuggestionCard", "click", "besSuggestion"),
    ("home", "click", "investmentStrategies"),
    ("pushNotification", "open", "campaign"),
    ("manageComparisonItems", "click", "apply"),
    ("filterSelection", "click", "risk"),
    ("transactionsHistory", "open", "list"),
    ("home", "click", "generalSummary"),
    ("background", "open", "app is on background"),
    ("foreground", "open", "app is on foreground ios"),
    ("account", "click", "cancelTransaction"),
    ("account", "click", "griHelpCenter"),
    ("bottomPopup", "click", "signUp"),
    ("bottomPopup", "click", "signIn"),
    ("orderDetail", "close", "done"),
    ("fundDetails", "click", "addFavourite"),
    ("feeds", "click", "close"),
    ("profiling", "click", "startAnalysis"),
    ("signIn", "click", "auto login"),
    ("home", "open", "chart"),
    ("bottomTabBar", "click", "Portföyüm"),
    ("account", "click", "withdraw"),
    ("search", "click", "query"),
)


# Picking from a literal list: ``(before, after)`` the listed texts, per engine.
SPARK_LIST = ("element_at(array(", "), k % 32 + 1)")
OTHER_LIST = ("list_extract([", "], k % 32 + 1)")

# A fund code of three digits and letters, per engine.
SPARK_CODE = r"lpad(conv(CAST(\1 AS STRING), 10, 36), 3, '0')"
OTHER_CODE = r"to_base(CAST(\1 AS BIGINT), 36, 3)"


def _spelled(text: str, timestamp: str, pick: tuple[str, str], code: str) -> str:
    """The view in one engine's spelling."""
    for position, part in enumerate(("view", "action", "detail")):
        listed = ", ".join(f"'{event[position]}'" for event in EVENT_CATALOGUE)
        text = text.replace(f"{{pick_{part}}}", listed.join(pick))
    return re.sub(r"CODE\[(.*?)\]", code, text.replace("{ts}", timestamp))


VIEWS = {
    "members": """
SELECT c_custkey AS serno, CASE WHEN c_custkey % 20 = 19 THEN 'P' ELSE 'A' END AS status,
 CASE WHEN c_custkey % 7 = 6 THEN 'guest' ELSE 'named' END AS account_type,
 CASE WHEN c_custkey % 11 = 10 THEN '0' ELSE '1' END AS mobile_number_verified,
 {ts} '2023-01-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE AS creation_time,
 CASE WHEN c_custkey % 13 <> 12 THEN {ts} '2023-02-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE END AS registration_time,
 CASE WHEN c_custkey % 3 <> 2 THEN {ts} '2023-03-01 00:00:00' + c_custkey * INTERVAL '1' MINUTE END AS account_ready_time,
 CASE WHEN c_custkey % 41 <> 40 THEN CAST(1950 + c_custkey % 58 AS INT) END AS birth_year,
 c_mktsegment AS occupation, CASE c_nationkey % 4 WHEN 0 THEN 'BSc' WHEN 1 THEN 'MSc' WHEN 2 THEN 'HS' END AS education,
 CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS interest_preference,
 CASE WHEN c_custkey % 5 = 0 THEN 'pic' END AS profile_picture FROM {customer}
""",
    "serno_mapping": """
SELECT c_custkey AS actual_serno, 5000000000000 + (c_custkey * 7919 + 13) % 1000000007 AS random_serno
FROM {customer} WHERE c_custkey % 50 <> 49
""",
    "funds": """
SELECT CODE[k] AS code, CAST(1 + sizes % 7 AS INT) AS risk_value, category,
 CASE WHEN k < 10 OR type = 'ECONOMY' THEN 'Katılım' WHEN type = 'PROMO' THEN 'Otonom Portföy' ELSE type END AS asset_class
FROM (SELECT p_partkey % 46656 AS k, SUM(p_size) AS sizes, MIN(p_brand) AS category, MIN_BY(p_type, p_partkey) AS type
 FROM {part} GROUP BY 1) p
""",
    "fund_lists": """
SELECT DATE '2024-01-01' + CAST(floor(p_partkey / 100) % 5 AS INT) AS day, CODE[p_partkey % 46656] AS fund_code,
 CASE WHEN p_partkey % 5 = 0 AND p_size > 10 THEN 'Popular' ELSE 'New' END AS list_type FROM {part}
""",
    "activity": """
SELECT event_id, member_serno, {pick_view} AS view_name, {pick_action} AS activity,
 CASE WHEN k % 32 IN (3,4,5,6) THEN concat({pick_detail}, ',', CODE[event_id % (CASE WHEN member_serno % 10 = 3 THEN 10 ELSE 100 END)]) ELSE {pick_detail} END AS details,
 client_time, server_time FROM (SELECT event_id, user_id AS member_serno, CAST(substring(props, 7, length(props) - 7) AS INT) AS k,
 ts AS client_time, ts + INTERVAL '2' SECOND AS server_time FROM {events}) e
""",
    "accounts": """
SELECT c_custkey AS serno, c_custkey AS member_serno, 'A' AS status FROM {customer}
 UNION ALL SELECT c_custkey + 1000000000000, c_custkey, 'A' FROM {customer} WHERE c_custkey % 10 = 0
""",
    "portfolios": """
SELECT c_custkey AS serno, c_custkey AS account_serno, 'movable' AS type, DATE '2023-03-01' AS create_date FROM {customer}
 UNION ALL SELECT c_custkey + 2000000000000, c_custkey, 'movable', DATE '2023-06-01' FROM {customer} WHERE c_custkey % 4 = 0
 UNION ALL SELECT c_custkey + 3000000000000, c_custkey + 1000000000000, 'fixed', DATE '2023-07-01' FROM {customer} WHERE c_custkey % 10 = 0
""",
    "transactions": """
SELECT o_orderkey AS serno, CAST(floor(o_custkey / 10) AS BIGINT) AS account_serno,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'CIN' WHEN '2-HIGH' THEN 'COU' WHEN '4-NOT SPECIFIED' THEN 'SEL' ELSE 'BUY' END AS tx_type,
 {ts} '2023-11-01 00:00:00' + ((o_orderkey * 37) % 131040) * INTERVAL '1' MINUTE AS tx_time,
 CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
 CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN CODE[(o_orderkey * 7) % 100] END AS fund_code FROM {orders}
""",
    "fund_orders": """
SELECT l_orderkey * 10 + l_linenumber AS serno, CAST(floor(o_custkey / 10) AS BIGINT) AS portfolio_serno,
 CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'E' END AS status, CASE WHEN l_linestatus = 'O' THEN 'U' ELSE 'S' END AS cancelled_by,
 {ts} '2023-11-01 00:00:00' + ((l_orderkey * 41) % 131040) * INTERVAL '1' MINUTE AS cancel_time,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CODE[l_partkey % 46656] AS fund_code
 FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
""",
    "eod_holdings": """
SELECT CAST(floor(o_custkey / 10) AS BIGINT) + CASE WHEN l_linenumber % 2 = 0 AND CAST(floor(o_custkey / 10) AS BIGINT) % 4 = 0 THEN 2000000000000 ELSE 0 END AS portfolio_serno,
 CODE[l_partkey % (CASE WHEN CAST(floor(o_custkey / 10) AS BIGINT) % 10 = 3 THEN 10 ELSE 20 END)] AS fund_code, 'TRY' AS currency,
 DATE '2023-11-01' + CAST((l_orderkey * 3 + l_suppkey) % 92 AS INT) AS day, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS size
 FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4
""",
    "eod_accounts": """
SELECT CAST(floor(o_custkey / 10) AS BIGINT) AS account_serno, DATE '2023-11-01' + CAST((l_orderkey * 3 + l_suppkey) % 92 AS INT) AS day, 'TRY' AS currency,
 SUM(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_quantity * 100 AS DECIMAL(18,2))) AS size, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS movable_size
 FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY 1, 2, 3
""",
    "recorded_ibans": """
SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(floor(c_custkey / 10) AS BIGINT) ELSE c_custkey END AS member_serno, CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'P' END AS status,
 DATE '2023-05-01' + CAST(c_custkey % 200 AS INT) AS last_used_date FROM {customer}
""",
    "survey_definitions": """
SELECT CAST(1 AS BIGINT) AS serno, 'Investor-Profile-Survey' AS name UNION ALL SELECT CAST(2 AS BIGINT), 'Other-Survey'
""",
    "survey_instances": """
SELECT c_custkey AS serno, c_custkey AS member_serno, CASE WHEN c_custkey % 9 = 8 THEN 2 ELSE 1 END AS definition_serno,
 CASE WHEN c_custkey % 6 <> 5 THEN {ts} '2023-04-01 00:00:00' END AS completed FROM {customer}
""",
    "survey_results": """
SELECT c_custkey AS instance_serno, 'Risk-Score' AS result_key, CAST(c_custkey % 7 + 1 AS STRING) AS result_value FROM {customer}
 UNION ALL SELECT c_custkey, 'BIT', CASE WHEN c_custkey % 4 = 3 THEN 'false' ELSE CAST(c_custkey % 100 AS STRING) END FROM {customer}
""",
}


def tables_used(name: str) -> list[str]:
    return [t for t in BASE_TABLES if f"{{{t}}}" in VIEWS[name]]


def sql_text(name: str) -> str:
    """The view as plain SQL over the test tables' own names."""
    text = _spelled(VIEWS[name], "TIMESTAMP", OTHER_LIST, OTHER_CODE)
    return re.sub(r"\{(\w+)\}", r"\1", text).strip()


class SampleSources(Mapping):
    """Source tables by name, derived on demand from the parquet files in ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            base = {t: self._base(t) for t in tables_used(name)}
            text = _spelled(VIEWS[name], "TIMESTAMP_NTZ", SPARK_LIST, SPARK_CODE)
            self._made[name] = self.spark.sql(text, **base)
        return self._made[name]

    def _base(self, table: str) -> DataFrame:
        if table not in self._made:
            self._made[table] = self.spark.read.parquet(f"{self.root}/{table}.parquet")
        return self._made[table]

    def __iter__(self):
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)
