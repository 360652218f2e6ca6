from datetime import date

from folioscope import constants as K
from folioscope.operators import fund_monthly, monthly, static
from tests.frames import at, day, landed, money, rows


def test_texts_that_name_no_month_are_left_out(spark):
    table = landed(
        spark,
        "monthly_outstandings",
        [
            (1, "2024/01", money(10), money(4)),
            (1, "2024/01", money(5), None),
            (1, "2024-01", money(99), money(99)),
            (1, "2024/13", money(99), money(99)),
            (1, None, money(99), money(99)),
        ],
    )
    assert rows(monthly.ym_volumes(table)) == [(1, 2024, 1, money(4), money(15))]


def test_summary_row(spark):
    actions = [
        (1, K.FUND_BUY, at("2024-01-05 05:00:00"), money(3), "F01"),
        (1, K.FUND_SELL, at("2024-01-05 10:59:59"), money(4), "F01"),
        (1, K.CASH_IN, at("2024-01-05 23:00:00"), money(50), "NA"),
        (1, K.CASH_IN, None, money(50), "NA"),
    ]
    views = [
        (1, "open", "F01", at("2024-01-05")),
        (1, "back", "F02", at("2024-01-05")),
        (1, "open", "F99", at("2024-01-05")),
    ]
    summary = monthly.summary_year_month(
        landed(spark, "monthly_outstandings", [(1, "2024/01", money(10), money(4)), (2, "2024/01", money(0), money(0))]),
        landed(spark, "actions", actions),
        landed(spark, "fund_actions", views),
        landed(spark, "daily_outstandings", [(1, money(1), money(0), day("2024-01-01")), (1, money(2), money(0), day("2024-01-02"))]),
        landed(spark, "monthly_outstanding_funds", [(1, "2024/01", "F01", money(3)), (1, "2024/01", "F99", money(9))]),
        landed(spark, "fund_details", [("F01", 5, "c", "a"), ("F02", 1, "c", "a")]),
    )
    first, second = summary.orderBy("cust_id").collect()
    assert first.asDict() == {
        "cust_id": 1,
        "year": 2024,
        "month": 1,
        "fund_balance_ratio": 0.4,
        "average_outstanding": 1.5,
        "outstanding_trend": 1,
        "interested_fund_count": 3,
        "interested_fund_risk": 5.0,
        "transaction_volume": money(7),
        "owned_fund_count": 2,
        "owned_fund_risk": 5.0,
        "activity_score": 3,
        "early_morning_activity_percentage": 66.67,
        "work_time_activity_percentage": 0.0,
        "evening_activity_percentage": 0.0,
        "night_activity_percentage": 33.33,
    }
    # No account volume gives no ratio, and a month without other rows no measures.
    assert [v for v in second] == [2, 2024, 1] + [None] * 13


def test_hour_buckets(spark):
    hours = [(1, K.CASH_IN, at(f"2024-01-05 {h:02}:30:00"), money(1), "NA") for h in range(24)]
    counts = monthly.ym_hourly_activity(landed(spark, "actions", hours))
    assert rows(counts) == [(1, 2024, 1, 6, 6, 6, 6)]


def test_volume_is_zero_without_trades(spark):
    log = landed(spark, "actions", [(1, K.CASH_IN, at("2024-01-05"), money(5), "NA")])
    assert rows(monthly.ym_transaction_volume(log)) == [(1, 2024, 1, money(0))]


def test_fund_summary_keeps_keys_of_any_source(spark):
    summary = fund_monthly.summary_year_month_fund(
        landed(spark, "fund_actions", [(1, "open", "F01", at("2024-01-05")), (1, "open", None, at("2024-01-05"))]),
        landed(
            spark,
            "actions",
            [
                (1, K.FUND_BUY, at("2024-01-05"), money(3), "F01"),
                (1, K.CASH_IN, at("2024-01-05"), money(8), "NA"),
                (1, K.CASH_IN, at("2024-01-05"), money(8), None),
            ],
        ),
        landed(spark, "monthly_outstanding_funds", [(1, "2024/02", "F01", money(6)), (1, "2024/01", None, money(7))]),
    )
    # Unknown funds of two sources do not meet.
    assert rows(summary, "month", "fund_code", "fund_clicks", "fund_outstanding", "fund_transaction_volume") == [
        (1, None, None, money(7), None),
        (1, None, 1, None, None),
        (1, "F01", 1, None, money(3)),
        (1, "NA", None, None, money(8)),
        (2, "F01", None, money(6), None),
    ]


def test_static_repeats_rows_of_repeated_answers(spark):
    details = landed(
        spark,
        "member_details",
        [(1, 1999, "j", None, "Y", None, None), (2, 1984, "j", None, "Y", None, None), (3, None, "j", None, "Y", None, None)],
    )
    bias = landed(spark, "bias_results", [(1, "BIT", "5"), (1, "BIT", "6"), (2, "Risk-Score", "3")])
    found = static.summary_static(details, bias, date(2024, 1, 31))
    assert rows(found, "cust_id", "age_range", "survey_risk", "bit_score") == [
        (1, "0-25", None, "5"),
        (1, "0-25", None, "6"),
        (2, "26-40", "3", None),
        (3, "40+", None, None),
    ]
