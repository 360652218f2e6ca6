"""The feature matrix: one row per customer, one column per behaviour."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioscope import constants as K
from folioscope.functions import times

# Column order of the matrix.
FEATURES = (
    "katilim_yatirim",
    "addBankAccount",
    "settings",
    "bes",
    "otonom",
    "pushNotification",
    "compare",
    "filterselection",
    "sorting",
    "otonombuy",
    "transactionsHistory",
    "generalsummary",
    "background",
    "foreground",
    "canceltransaction",
    "grihelpcenter",
    "signup_night",
    "signin_night",
    "order_night",
    "addfavourite",
    "age_28_48",
    "has_account_ready",
    "faiz_okey",
    "video_izleyen",
    "dya_gece",
    "katilim_ilgi",
    "dya_score",
    "popular_fund_ratio",
    "yeni_portfoy",
    "birden_fazla_banka_hesabi",
)
# The one feature that stays NULL where nothing was ever measured.
NO_DEFAULT = ("popular_fund_ratio",)


# Conditions and measures below are SQL expressions: a matrix of thirty columns
# is planned much faster from texts than from nested column calls.


def _mentions(column: str, word: str) -> str:
    return f"contains(lower({column}), '{word.lower()}')"


# App events


def _event_condition(name: str) -> str:
    rule = K.EVENT_FEATURES[name]
    terms = []
    for key, column in (("view", "view_name"), ("action", "action"), ("details", "details")):
        if key in rule:
            terms.append(_mentions(column, rule[key]))
        if f"{key}_is" in rule:
            terms.append(f"{column} = '{rule[f'{key}_is']}'")
    if rule.get("night"):
        terms.append("(hour(event_time) >= 22 OR hour(event_time) < 6)")
    return " AND ".join(terms)


def event_features(
    digital_actions: DataFrame, names: Collection[str] = tuple(K.EVENT_FEATURES)
) -> DataFrame:
    """Any number of event features from one pass over the events.

    A feature without a match is NULL; customers without any match are left out.
    """
    conditions = {name: _event_condition(name) for name in names}
    hits = digital_actions.filter(" OR ".join(f"({c})" for c in conditions.values()))
    measures = []
    for name, condition in conditions.items():
        add = "max" if K.EVENT_FEATURES[name]["kind"] == "flag" else "sum"
        measures.append(F.expr(f"{add}(CASE WHEN {condition} THEN 1 END) AS {name}"))
    return hits.groupBy("customer_id").agg(*measures)


# Purchases that follow a look at strategies

STRATEGY_WEEK = f"floor(datediff(at, DATE '1970-01-05') / {K.STRATEGY_DAYS})"


def otonombuy(digital_actions: DataFrame, actions: DataFrame) -> DataFrame:
    """Customers with more than one (strategy view, fund purchase within 7 days) pair.

    Only "more than one" matters, so no pair is listed.  Time is cut into weeks:
    within a week a pair holds if the view comes first, across neighbouring
    weeks if at most seven days lie between, and further apart never.  If two
    pairs hold, two also hold among the two earliest views and two latest
    purchases of a week, and likewise the two latest views and two earliest
    purchases of neighbouring weeks; those are all that is kept.

    Every row stands in both contests, told apart by ``across``, with a rank
    that puts the wanted end first.  The row_number limit is applied before the
    shuffle too, so of a customer with very many rows only two per task, week
    and contest travel.
    """
    seen = digital_actions.filter(_mentions("details", K.STRATEGY_WORD)).selectExpr(
        "customer_id", "true AS is_view", "event_time AS at"
    )
    at = times.as_time(actions, "timestamp")
    bought = (
        actions.filter(_mentions("action_type", K.FUND_BUY))
        .select("customer_id", F.lit(False).alias("is_view"), at.alias("at"))
        .filter("at IS NOT NULL")
    )
    contests = (
        seen.unionByName(bought)
        .selectExpr("*", f"{STRATEGY_WEEK} AS week", "explode(array(false, true)) AS across")
        .selectExpr(
            "customer_id",
            "is_view",
            "at",
            "across",
            # A view meets the purchases of the next week in the contest across weeks.
            "week + int(across AND is_view) AS week",
            "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', at)"
            " * CASE WHEN is_view = across THEN -1 ELSE 1 END AS rank",
        )
    )
    group = ["customer_id", "across", "week"]
    ends = W.partitionBy(*group, "is_view").orderBy("rank")
    kept = contests.withColumn("n", F.row_number().over(ends)).filter("n <= 2")
    pairs = (
        kept.groupBy(*group)
        .agg(
            *[
                F.expr(f"min(CASE WHEN {side} AND n = {n} THEN at END) AS {name}{n}")
                for side, name in (("is_view", "v"), ("NOT is_view", "p"))
                for n in (1, 2)
            ]
        )
        .selectExpr(
            "customer_id",
            " + ".join(
                f"int(coalesce(v{v} <= p{p} AND p{p} <= v{v} + INTERVAL {K.STRATEGY_DAYS} DAYS, false))"
                for v in (1, 2)
                for p in (1, 2)
            )
            + " AS pairs",
        )
    )
    return (
        pairs.groupBy("customer_id")
        .agg(F.sum("pairs").alias("pairs"))
        .filter("pairs > 1")
        .selectExpr("customer_id", "1 AS otonombuy")
    )


# Members, surveys, holdings and actions

HAS_BIT = f"result_key = '{K.BIT_KEY}'"
IS_READY = "account_ready_time IS NOT NULL"
TAKES_INTEREST = "interest_preference = 'Y'"
IS_OPEN = "action_type = 'open'"
IS_PURCHASE = f"(action_type = '{K.FUND_BUY}' AND fund_code IS NOT NULL)"
IS_NEW_PORTFOLIO = f"action_type = '{K.NEW_PORTFOLIO}'"
IS_MULTI_IBAN = f"action_type = '{K.MULTI_IBAN}'"


def _of_age(as_of) -> str:
    return f"year(DATE '{as_of}') - birth_year BETWEEN {K.AGE_FROM} AND {K.AGE_TO}"


def _flagged(df: DataFrame, condition: str, name: str) -> DataFrame:
    return df.filter(condition).selectExpr("customer_id", f"1 AS {name}").distinct()


def dya_score(bias: DataFrame) -> DataFrame:
    return _flagged(bias, HAS_BIT, "dya_score")


def has_account_ready(details: DataFrame) -> DataFrame:
    return _flagged(details, IS_READY, "has_account_ready")


def age_28_48(details: DataFrame, as_of) -> DataFrame:
    return _flagged(details, _of_age(as_of), "age_28_48")


def faiz_okey(details: DataFrame) -> DataFrame:
    return _flagged(details, TAKES_INTEREST, "faiz_okey")


def _marked(df: DataFrame, codes: DataFrame, name: str) -> DataFrame:
    """Add ``name``: whether the row's ``fund_code`` is one of ``codes``."""
    listed = codes.distinct().withColumn("__found", F.lit(True))
    return df.join(listed, "fund_code", "left").selectExpr(
        *df.columns, f"__found IS NOT NULL AS {name}"
    )


def _with_participation(df: DataFrame, funds: DataFrame) -> DataFrame:
    codes = funds.filter(f"asset_class = '{K.PARTICIPATION_ASSET_CLASS}'")
    return _marked(df, codes.selectExpr("code AS fund_code"), "is_participation")


def _with_popular(actions: DataFrame, popular: DataFrame) -> DataFrame:
    """A fund is popular if any day lists it."""
    return _marked(actions, popular.select("fund_code"), "is_popular")


def _mostly(part: str, whole: str) -> str:
    share = f"try_divide(double(coalesce({part}, 0)), double({whole}))"
    return f"({whole} > 0 AND {share} > double({K.PARTICIPATION_SHARE}))"


def _popular_ratio(popular: str, bought: str) -> str:
    return f"coalesce(try_divide(double({popular}), double({bought})), 0D)"


def katilim_yatirim(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Customers whose month-end holdings were mostly participation funds."""
    sums = (
        _with_participation(holdings, funds)
        .groupBy("customer_id")
        .agg(
            F.expr("sum(CASE WHEN is_participation THEN size END) AS part"),
            F.expr("sum(size) AS whole"),
        )
    )
    return _flagged(sums, _mostly("part", "whole"), "katilim_yatirim")


def katilim_ilgi(fund_actions: DataFrame, funds: DataFrame) -> DataFrame:
    """Customers that opened mostly participation funds.

    The table is a choice: only fund views have 'open' rows.  The action log,
    which has none, gives no customer at all.
    """
    counts = (
        _with_participation(fund_actions.filter(IS_OPEN), funds)
        .groupBy("customer_id")
        .agg(F.expr("count_if(is_participation) AS part"), F.expr("count(1) AS whole"))
    )
    return _flagged(counts, _mostly("part", "whole"), "katilim_ilgi")


def popular_fund_ratio(actions: DataFrame, popular: DataFrame) -> DataFrame:
    """Share of fund purchases that went into popular funds, for every customer with actions."""
    counts = (
        _with_popular(actions, popular)
        .groupBy("customer_id")
        .agg(
            F.expr(f"count_if({IS_PURCHASE} AND is_popular) AS popular"),
            F.expr(f"count_if({IS_PURCHASE}) AS bought"),
        )
    )
    ratio = _popular_ratio("popular", "bought")
    return counts.selectExpr("customer_id", f"{ratio} AS popular_fund_ratio")


def yeni_portfoy(actions: DataFrame) -> DataFrame:
    return _flagged(actions, IS_NEW_PORTFOLIO, "yeni_portfoy")


def birden_fazla_banka_hesabi(actions: DataFrame) -> DataFrame:
    return _flagged(actions, IS_MULTI_IBAN, "birden_fazla_banka_hesabi")


# The matrix


def feature_population(
    digital_actions: DataFrame, actions: DataFrame, details: DataFrame
) -> DataFrame:
    ids = [df.select("customer_id") for df in (digital_actions, actions, details)]
    return ids[0].union(ids[1]).union(ids[2]).distinct()


def feature_updates(
    digital_actions: DataFrame,
    actions: DataFrame,
    fund_actions: DataFrame,
    details: DataFrame,
    bias: DataFrame,
    holdings: DataFrame,
    funds: DataFrame,
    popular: DataFrame,
    as_of,
    legacy_interest: bool = False,
) -> DataFrame:
    """All features of the whole population; NULL where nothing was measured.

    Every source row becomes a narrow row of marks, the marks are united, and
    one grouping by customer adds them up.  So there is one shuffle, of rows
    already added up per task, and no join between customer tables; the
    population falls out of the same grouping.  ``legacy_interest`` takes the
    fund interest from the action log instead of the fund views.
    """

    def marks(df: DataFrame, known: bool = False, **conditions: str) -> DataFrame:
        """1 or NULL per condition; ``known`` rows make their customer part of the population."""
        columns = [f"CASE WHEN {c} THEN 1 END AS {name}" for name, c in conditions.items()]
        return df.selectExpr("customer_id", *(["1 AS __known"] if known else []), *columns)

    opens = actions if legacy_interest else fund_actions
    sources = [
        marks(digital_actions, True, **{name: _event_condition(name) for name in K.EVENT_FEATURES}),
        marks(
            _with_popular(actions, popular),
            True,
            __acted="true",
            __bought=IS_PURCHASE,
            __popular=f"{IS_PURCHASE} AND is_popular",
            yeni_portfoy=IS_NEW_PORTFOLIO,
            birden_fazla_banka_hesabi=IS_MULTI_IBAN,
        ),
        marks(
            details,
            True,
            has_account_ready=IS_READY,
            age_28_48=_of_age(as_of),
            faiz_okey=TAKES_INTEREST,
        ),
        marks(bias, dya_score=HAS_BIT),
        _with_participation(holdings, funds).selectExpr(
            "customer_id",
            "CAST(size AS DECIMAL(28,2)) AS __held",
            "CASE WHEN is_participation THEN CAST(size AS DECIMAL(28,2)) END AS __held_part",
        ),
        marks(
            _with_participation(opens.filter(IS_OPEN), funds),
            __opened="true",
            __opened_part="is_participation",
        ),
        otonombuy(digital_actions, actions),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    summed = {name for name, rule in K.EVENT_FEATURES.items() if rule["kind"] == "count"}
    summed |= {"__bought", "__popular", "__held", "__held_part", "__opened", "__opened_part"}
    measures = [
        F.expr(f"{'sum' if c in summed else 'max'}({c}) AS {c}")
        for c in rows.columns
        if c != "customer_id"
    ]
    derived = {
        "katilim_yatirim": f"CASE WHEN {_mostly('__held_part', '__held')} THEN 1 END",
        "katilim_ilgi": f"CASE WHEN {_mostly('__opened_part', '__opened')} THEN 1 END",
        "popular_fund_ratio": "CASE WHEN __acted = 1 THEN "
        + _popular_ratio("coalesce(__popular, 0)", "__bought")
        + " END",
    }
    return (
        rows.groupBy("customer_id")
        .agg(*measures)
        .filter("__known = 1")
        .selectExpr("customer_id", *[f"{derived.get(name, name)} AS {name}" for name in FEATURES])
    )


def _default(name: str) -> str:
    return name if name in NO_DEFAULT else f"coalesce({name}, 0) AS {name}"


def unmeasured(population: DataFrame, schema: StructType) -> DataFrame:
    """The matrix before anything was measured; ``schema`` is that of the updates."""
    nulls = [f"CAST(NULL AS {schema[name].dataType.simpleString()}) AS {name}" for name in FEATURES]
    return population.selectExpr("customer_id", *nulls)


def feature_defaults(updates: DataFrame) -> DataFrame:
    """Fill what was never measured: 0, but no ratio of purchases where there is no action."""
    return updates.selectExpr("customer_id", *[_default(name) for name in FEATURES])


def feature_merge(updates: DataFrame, previous: DataFrame) -> DataFrame:
    """Lay ``updates`` over an earlier matrix; what was not measured again keeps its value.

    Customers of the earlier matrix stay, and new ones enter.
    """
    old = previous.selectExpr("customer_id", *[f"{name} AS __{name}" for name in FEATURES])
    merged = updates.join(old, "customer_id", "full_outer").selectExpr(
        "customer_id", *[f"coalesce({name}, __{name}) AS {name}" for name in FEATURES]
    )
    return feature_defaults(merged)
