import random
from datetime import date, timedelta

import pytest

from folioscope import constants as K
from folioscope.operators import features
from tests.frames import at, day, landed, money, rows

AS_OF = date(2024, 1, 31)


def view(customer, when, details="investmentStrategies", name="home", action="click"):
    return (customer, name, action, details, at(when) if isinstance(when, str) else when)


def buy(customer, when, fund="F01", action=K.FUND_BUY):
    return (customer, action, at(when) if isinstance(when, str) else when, money(1), fund)


def test_event_conditions(spark):
    events = landed(
        spark,
        "digital_actions",
        [
            view(1, "2024-01-05 23:00:00", "Signin", "BottomPopup"),
            view(1, "2024-01-05 05:59:59", "signIn,x", "bottomPopup"),
            view(1, "2024-01-05 06:00:00", "signin", "bottomPopup"),
            view(1, "2024-01-05 21:59:59", "signin", "bottomPopup"),
            view(1, "2024-01-05 23:00:00", "Close", "feeds"),
            view(2, "2024-01-05 23:00:00", "close", "feeds"),
            view(2, "2024-01-05 23:00:00", "sİgnin", "bottomPopup"),
            view(3, "2024-01-05 12:00:00", "x", "mySettings"),
        ],
    )
    found = features.event_features(events, ["signin_night", "video_izleyen", "settings"])
    assert rows(found) == [(1, 2, None, None), (2, None, 1, None), (3, None, None, 1)]


def test_one_pass_gives_what_each_feature_gives_alone(spark):
    rng = random.Random(5)
    words = ["addBankAccount", "settings", "close", "signUp", "apply", "startAnalysis"]
    views = ["settings", "bottomPopup", "feeds", "manageComparisonItems", "profiling", "background"]
    events = landed(
        spark,
        "digital_actions",
        [
            view(
                rng.randrange(5),
                at("2024-01-05") + timedelta(hours=rng.randrange(48)),
                rng.choice(words),
                rng.choice(views),
                rng.choice(["open", "click"]),
            )
            for _ in range(200)
        ],
    )
    together = features.event_features(events)
    for name in ("addBankAccount", "settings", "compare", "signup_night", "dya_gece", "background"):
        alone = features.event_features(events, [name])
        assert rows(alone) == rows(together.filter(f"{name} IS NOT NULL"), "customer_id", name)


def brute_force_buyers(views, buys):
    pairs = {}
    for customer, seen in views:
        for other, bought in buys:
            if customer == other and seen <= bought <= seen + timedelta(days=7):
                pairs[customer] = pairs.get(customer, 0) + 1
    return sorted((c, 1) for c, n in pairs.items() if n > 1)


@pytest.mark.parametrize("seed", range(4))
def test_purchases_after_strategies_equal_brute_force(spark, seed):
    rng = random.Random(seed)

    def moment():
        return at("2024-01-01") + timedelta(hours=6 * rng.randrange(70))

    # Few rows per customer, so that counts of 0, 1 and 2 pairs are all common.
    views = [(c, moment()) for c in range(80) for _ in range(rng.randrange(4))]
    buys = [(c, moment()) for c in range(80) for _ in range(rng.randrange(4))]
    views += [(99, moment()) for _ in range(80)]
    buys += [(99, moment()) for _ in range(80)]
    found = features.otonombuy(
        landed(spark, "digital_actions", [view(c, t) for c, t in views]),
        landed(
            spark,
            "actions",
            [buy(c, t) for c, t in buys] + [buy(c, t, action=K.FUND_SELL) for c, t in buys],
        ),
    )
    expected = brute_force_buyers(views, buys)
    assert sorted(rows(found)) == expected and 5 < len(expected) < 75


@pytest.mark.parametrize(
    "views, buys, expected",
    [
        (["2024-01-05 10:00:00"], ["2024-01-05 10:00:00", "2024-01-12 10:00:00"], [(1, 1)]),
        (["2024-01-05 10:00:00"], ["2024-01-05 09:59:59", "2024-01-12 10:00:00"], []),
        (["2024-01-05 10:00:00"], ["2024-01-05 10:00:00", "2024-01-12 10:00:01"], []),
        (["2024-01-05 10:00:00"] * 2, ["2024-01-06 10:00:00"], [(1, 1)]),
    ],
)
def test_edges_of_the_seven_days(spark, views, buys, expected):
    found = features.otonombuy(
        landed(spark, "digital_actions", [view(1, t) for t in views]),
        landed(spark, "actions", [buy(1, t) for t in buys]),
    )
    assert rows(found) == expected


FUNDS = [("F01", 1, "c", K.PARTICIPATION_ASSET_CLASS), ("F02", 1, "c", "x")]


def tables(spark, **given):
    empty = {name: [] for name in ("digital_actions", "actions", "fund_actions", "member_details")}
    empty |= {"bias_results": [], "monthly_outstanding_funds": [], "popular_funds": []}
    empty |= {"fund_details": FUNDS, **given}
    made = {name: landed(spark, name, list(data)) for name, data in empty.items()}
    return (
        made["digital_actions"],
        made["actions"],
        made["fund_actions"],
        made["member_details"],
        made["bias_results"],
        made["monthly_outstanding_funds"],
        made["fund_details"],
        made["popular_funds"],
    )


def test_holdings_need_more_than_the_share(spark):
    holdings = landed(
        spark,
        "monthly_outstanding_funds",
        [
            (1, "2024/01", "F01", money(80)),
            (1, "2024/01", "F02", money(20)),
            (2, "2024/01", "F01", money(81)),
            (2, "2024/01", "F02", money(19)),
            (3, "2024/01", "F01", money(0)),
            (4, "2024/01", "F77", money(5)),
        ],
    )
    found = features.katilim_yatirim(holdings, landed(spark, "fund_details", FUNDS))
    assert rows(found) == [(2, 1)]


def test_interest_comes_from_fund_views_unless_legacy(spark):
    opened = [(1, "open", "F01", at("2024-01-05"))]
    args = tables(spark, fund_actions=opened, actions=[buy(1, "2024-01-05")])
    plain = features.feature_updates(*args, AS_OF)
    legacy = features.feature_updates(*args, AS_OF, legacy_interest=True)
    assert rows(plain, "katilim_ilgi") == [(1,)]
    assert rows(legacy, "katilim_ilgi") == [(None,)]


def test_population_and_defaults(spark):
    details = [(1, 1984, "job", None, "Y", None, None)]
    args = tables(
        spark,
        digital_actions=[view(2, "2024-01-05 10:00:00", "main", "settings")],
        actions=[buy(3, "2024-01-05"), buy(4, "2024-01-05", action=K.CASH_IN)],
        member_details=details,
        bias_results=[(1, "BIT", "5"), (9, "BIT", "5")],
        popular_funds=[(day("2024-01-01"), "F01"), (day("2024-01-02"), "F01")],
    )
    matrix = features.feature_defaults(features.feature_updates(*args, AS_OF))
    found = rows(
        matrix, "customer_id", "settings", "age_28_48", "dya_score", "faiz_okey",
        "has_account_ready", "popular_fund_ratio", "yeni_portfoy",
    )
    assert found == [
        (1, 0, 1, 1, 1, 0, None, 0),
        (2, 1, 0, 0, 0, 0, None, 0),
        (3, 0, 0, 0, 0, 0, 1.0, 0),
        (4, 0, 0, 0, 0, 0, 0.0, 0),
    ]
    assert rows(features.feature_population(args[0], args[1], args[3])) == [(1,), (2,), (3,), (4,)]


def test_unmeasured_features_keep_the_earlier_value(spark):
    before = features.feature_defaults(
        features.feature_updates(
            *tables(
                spark,
                digital_actions=[view(1, "2024-01-01 10:00:00", "main", "settings")] * 3
                + [view(5, "2024-01-01 10:00:00", "besSuggestion")],
                actions=[buy(1, "2024-01-01")],
            ),
            AS_OF,
        )
    )
    now = features.feature_updates(
        *tables(
            spark,
            digital_actions=[
                view(1, "2024-01-09 10:00:00", "generalSummary"),
                view(2, "2024-01-09 10:00:00", "main", "settings"),
            ],
        ),
        AS_OF,
    )
    merged = features.feature_merge(now, before)
    assert rows(merged, "customer_id", "settings", "generalsummary", "bes", "popular_fund_ratio") == [
        (1, 3, 1, 0, 0.0),
        (2, 1, 0, 0, None),
        (5, 0, 0, 1, None),
    ]
