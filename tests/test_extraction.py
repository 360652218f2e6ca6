from datetime import date

import pytest

from folioscope import constants as K
from folioscope.functions.times import as_time, display_timestamp
from folioscope.operators import actions, balances, events, members
from tests.frames import at, day, money, rows, source
from pyspark.sql import functions as F


def member(serno, status="A", kind="named", registered=True, mobile="1", ready=None, picture=None):
    return (
        serno,
        status,
        kind,
        at("2023-02-01") if registered else None,
        mobile,
        at(ready) if ready else None,
        1990,
        "job",
        None,
        "Y",
        at("2023-01-01"),
        picture,
    )


@pytest.fixture(scope="module")
def people(spark):
    return source(
        spark,
        "members",
        [
            member(1),
            member(2, status="P"),
            member(3, kind="guest"),
            member(4, kind="guest", ready="2023-03-01"),
            member(5, mobile="0", ready="2023-03-01"),
            member(6, registered=False),
            member(7, ready="2023-03-01", picture="x"),
        ],
    )


@pytest.fixture(scope="module")
def mapping(spark):
    return source(spark, "serno_mapping", [(1, 901), (4, 904), (4, 904)])


@pytest.fixture(scope="module")
def ids(people, mapping):
    return members.customer_ids(people, mapping)


def test_eligible_members(people):
    assert rows(members.eligible_members(people)) == [(1,), (4,), (7,)]


def test_unmapped_members_keep_their_id_unless_strict(people, mapping, ids):
    assert rows(ids) == [(1, 901), (4, 904), (7, 7)]
    assert rows(members.customer_ids(people, mapping, strict=True)) == [(1, 901), (4, 904)]


def test_pseudonymize_leaves_no_real_id_when_strict(spark, mapping):
    df = spark.createDataFrame([(1, "a"), (9, "b")], "member_serno bigint, x string")
    assert rows(members.pseudonymize(df, mapping)) == [(9, "b"), (901, "a")]
    assert rows(members.pseudonymize(df, mapping, strict=True)) == [(901, "a")]


def test_id_collisions(spark):
    found = spark.createDataFrame([(1, 5), (5, 5), (6, 7)], "member_serno bigint, customer_id bigint")
    assert rows(members.id_collisions(found)) == [(5,)]


def test_sample_is_repeatable_and_bounded(spark):
    everyone = source(spark, "members", [member(n) for n in range(200)])
    first = rows(members.members_without_account_sample(everyone, 20, seed=1))
    again = rows(members.members_without_account_sample(everyone.repartition(7), 20, seed=1))
    other = rows(members.members_without_account_sample(everyone, 20, seed=2))
    assert len(first) == 20 and first == again and first != other


def test_digital_actions_window_and_missing_texts(spark, ids):
    def event(member_serno, server):
        return (member_serno, None, "click", None, at("2024-01-05 10:00:00"), at(server))

    activity = source(
        spark,
        "activity",
        [
            event(1, "2024-01-01 00:00:00"),
            event(1, "2024-02-01 00:00:00"),
            event(2, "2024-01-10 00:00:00"),
        ],
    )
    window = (date(2024, 1, 1), date(2024, 2, 1))
    half_open = rows(events.digital_actions(activity, ids, *window))
    assert half_open == [(901, "", "click", "", at("2024-01-05 10:00:00"))]
    assert events.digital_actions(activity, ids, *window, closed=True).count() == 2


def test_fund_actions(spark, ids):
    when = at("2024-01-05 10:00:00")
    activity = source(
        spark,
        "activity",
        [
            (1, "fundsList", "click", "open,F01", when, when),
            (1, "fundDetails", "click", "back,F01", when, when),
            (1, "fundMarket", "click", "backwards,F01", when, when),
            (1, "fundMarket", "click", "open,F99", when, when),
            (1, "home", "click", "open,F01", when, when),
            (1, "fundsList", "click", None, when, when),
        ],
    )
    funds = source(spark, "funds", [("F01", 3, "c", "a")])
    found = events.fund_actions(activity, ids, funds, date(2024, 1, 1), date(2024, 2, 1))
    assert rows(found, "customer_id", "action_type", "fund_code") == [
        (901, "back", "F01"),
        (901, "open", "F01"),
        (901, "open", "F01"),
    ]


def account_ids(spark):
    return spark.createDataFrame(
        [(10, 1, 901), (11, 1, 901)],
        "account_serno bigint, member_serno bigint, customer_id bigint",
    )


def test_month_end_balances_keep_all_accounts_of_the_last_day(spark):
    eod = source(
        spark,
        "eod_accounts",
        [
            (10, day("2024-01-30"), "TRY", money(1), money(1)),
            (11, day("2024-01-31"), "TRY", money(2), money(1)),
            (10, day("2024-01-31"), "TRY", money(3), money(1)),
            (10, day("2024-02-02"), "USD", money(9), money(9)),
            (10, day("2024-02-10"), "TRY", money(4), money(1)),
            (10, day("2024-02-12"), "TRY", money(5), money(1)),
        ],
    )
    window = (date(2024, 1, 1), date(2024, 3, 1))

    def volumes(as_of, legacy=False):
        found = balances.monthly_outstandings(eod, account_ids(spark), *window, as_of, legacy)
        return rows(found.select("year_month", F.col("account_volume").cast("int")))

    january = [("2024/01", 2), ("2024/01", 3)]
    assert volumes(day("2024-02-12")) == [*january, ("2024/02", 5)]
    assert volumes(day("2024-02-11")) == [*january, ("2024/02", 4)]
    # Filed under the day before, today's balance is a second last day of the month.
    assert volumes(day("2024-02-12"), legacy=True) == [*january, ("2024/02", 4), ("2024/02", 5)]


def test_first_of_month_counts_for_the_month_before_when_legacy(spark):
    eod = source(
        spark,
        "eod_accounts",
        [
            (10, day("2024-01-31"), "TRY", money(3), money(1)),
            (10, day("2024-02-01"), "TRY", money(4), money(1)),
        ],
    )
    window = (date(2024, 1, 1), date(2024, 3, 1))
    today = day("2024-02-01")
    plain = balances.monthly_outstandings(eod, account_ids(spark), *window, today)
    legacy = balances.monthly_outstandings(eod, account_ids(spark), *window, today, legacy=True)
    assert rows(plain.select("year_month", F.col("account_volume").cast("int"))) == [
        ("2024/01", 3),
        ("2024/02", 4),
    ]
    assert rows(legacy.select("year_month", F.col("account_volume").cast("int"))) == [("2024/01", 4)]


def test_month_end_holdings_have_a_last_day_per_fund(spark):
    portfolio_ids = spark.createDataFrame(
        [(20, 1, 901), (21, 1, 901)],
        "portfolio_serno bigint, member_serno bigint, customer_id bigint",
    )
    eod = source(
        spark,
        "eod_holdings",
        [
            (20, "F01", "TRY", day("2024-01-30"), money(1)),
            (21, "F01", "TRY", day("2024-01-30"), money(2)),
            (20, "F02", "TRY", day("2024-01-30"), money(7)),
            (20, "F02", "TRY", day("2024-01-31"), money(5)),
        ],
    )
    args = (eod, portfolio_ids, date(2024, 1, 1), date(2024, 2, 1))
    plain = balances.monthly_outstanding_funds(*args, day("2024-01-31"))
    assert rows(plain.select("fund_code", F.col("size").cast("int"))) == [("F01", 3), ("F02", 5)]
    legacy = balances.monthly_outstanding_funds(*args, day("2024-01-31"), legacy=True)
    assert rows(legacy.select("fund_code", F.col("size").cast("int"))) == [("F01", 3), ("F02", 12)]


def test_portfolios_are_cut_to_their_last_day_before_the_join(spark):
    """A portfolio that ends earlier than another does not count; one in two entries counts twice."""
    portfolio_ids = spark.createDataFrame(
        [(20, 1, 901), (21, 1, 901), (22, 2, 902), (22, 2, 902)],
        "portfolio_serno bigint, member_serno bigint, customer_id bigint",
    )
    eod = source(
        spark,
        "eod_holdings",
        [
            (20, "F01", "TRY", day("2024-01-29"), money(1)),
            (20, "F01", "TRY", day("2024-01-30"), money(2)),
            (21, "F01", "TRY", day("2024-01-29"), money(4)),
            (22, "F01", "TRY", day("2024-01-30"), money(8)),
            (22, "F01", "TRY", day("2024-01-30"), money(16)),
            (22, None, "TRY", day("2024-01-30"), None),
            (None, "F01", "TRY", day("2024-01-30"), money(32)),
        ],
    )
    args = (eod, portfolio_ids, date(2024, 1, 1), date(2024, 2, 1), day("2024-01-31"))
    held = balances.monthly_outstanding_funds(*args)
    assert rows(held.select("customer_id", "fund_code", F.col("size").cast("int"))) == [
        (901, "F01", 2), (902, None, None), (902, "F01", 48),
    ]
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("max_by(size", plan.index("Join Inner"))


def test_display_timestamp(spark):
    df = spark.createDataFrame([(at("2024-01-05 09:07:30"),), (None,)], "t timestamp_ntz")
    assert rows(df.select(display_timestamp(F.col("t")))) == [("09.07-05.01.24",), ("N/A",)]


def test_display_text_reads_back_as_2000s(spark):
    df = spark.createDataFrame(
        [("09.07-05.01.24",), ("09.07-05.01.75",), ("N/A",), ("25.00-05.01.24",)], "t string"
    )
    assert rows(df.select(as_time(df, "t"))) == [
        (None,),
        (None,),
        (at("2024-01-05 09:07:00"),),
        (at("2075-01-05 09:07:00"),),
    ]


def test_transactions_carry_both_labels(spark):
    tx = source(
        spark,
        "transactions",
        [
            (1, 10, "BUY", at("2024-01-05 10:00:00"), money(5), "F01"),
            (2, 10, "SEL", at("2024-01-05 10:00:00"), money(6), "F02"),
            (3, 10, "CIN", at("2024-01-05 10:00:00"), money(7), "F01"),
            (4, 10, "BUY", at("2024-02-01 00:00:00"), money(8), "F01"),
            (5, 10, "XXX", at("2024-01-05 10:00:00"), money(9), "F01"),
            (6, 10, "BUY", at("2024-01-05 10:00:00"), None, None),
        ],
    )
    funds = source(spark, "funds", [("F01", 1, "c", K.AUTO_ASSET_CLASS), ("F02", 1, "c", "x")])
    window = (date(2024, 1, 1), date(2024, 2, 1))
    log = actions.transaction_actions(tx, account_ids(spark), funds, *window)
    assert rows(log, "action_type", "amount", "fund_code") == sorted(
        [
            (K.FUND_BUY, None, None),
            (K.FUND_BUY, money(5), "F01"),
            (K.AUTO_BUY, money(5), "F01"),
            (K.FUND_SELL, money(6), "F02"),
            (K.CASH_IN, money(7), "NA"),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_member_actions(people, ids):
    log = actions.member_actions(people, ids, date(2024, 1, 31))
    assert rows(log, "customer_id", "action_type", "timestamp") == sorted(
        [(c, K.DOWNLOAD, at("2023-01-01")) for c in (901, 904, 7)]
        + [(c, K.REGISTER, at("2023-02-01")) for c in (901, 904, 7)]
        + [(7, K.PROFILE_PICTURE, at("2024-01-31"))],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_new_portfolios_skip_the_first_movable_one(spark):
    portfolios = source(
        spark,
        "portfolios",
        [
            (30, 10, "movable", day("2023-03-01")),
            (31, 11, "movable", day("2023-04-01")),
            (29, 10, "fixed", day("2023-01-01")),
            (32, 10, "movable", day("2023-05-01")),
        ],
    )
    log = actions.new_portfolios(portfolios, account_ids(spark))
    assert rows(log, "timestamp") == [(at("2023-04-01"),), (at("2023-05-01"),)]


def test_multiple_ibans_count_all_states(spark, ids):
    ibans = source(
        spark,
        "recorded_ibans",
        [(1, "A", None), (1, "P", day("2023-01-01")), (4, "A", None), (99, "A", None), (99, "A", None)],
    )
    log = actions.multiple_ibans(ibans, ids, date(2024, 1, 31))
    assert rows(log, "customer_id") == [(901,)]
    ordered = members.recorded_ibans(ibans).collect()
    assert [tuple(r) for r in ordered][:2] == [(1, "A", None), (1, "P", day("2023-01-01"))]


def test_bias_results(spark, ids):
    found = events.bias_results(
        source(spark, "survey_results", [(1, "BIT", "false"), (1, "BIT", "5"), (2, "BIT", "6"), (3, "BIT", "7")]),
        source(
            spark,
            "survey_instances",
            [(1, 1, 1, at("2023-01-01")), (2, 1, 1, None), (3, 1, 2, at("2023-01-01"))],
        ),
        source(spark, "survey_definitions", [(1, K.PROFILE_SURVEY), (2, "Other")]),
        ids,
    )
    assert rows(found) == [(901, "BIT", "5")]
