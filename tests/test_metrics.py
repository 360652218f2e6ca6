import math
import random
from datetime import timedelta

import pandas as pd
import pytest

from folioscope import constants as K
from folioscope.operators import metrics
from tests.frames import at, day, landed, money, rows


def random_log(spark, seed=1, hours=24):
    rng = random.Random(seed)
    data = [
        (
            rng.randrange(4),
            rng.choice([K.FUND_BUY, K.FUND_SELL, K.CASH_IN]),
            at("2023-12-01") + timedelta(days=rng.randrange(60), hours=rng.randrange(hours)),
            money(rng.randrange(1000)),
            "F01",
        )
        for _ in range(150)
    ]
    return landed(spark, "actions", data), pd.DataFrame(
        data, columns=["customer_id", "action_type", "timestamp", "amount", "fund_code"]
    )


def test_scaled_activity_equals_pandas(spark):
    log, table = random_log(spark)
    counts = (
        table.groupby(["customer_id", table.timestamp.dt.year, table.timestamp.dt.month.rename("m")])
        .size()
        .astype(float)
    )
    scaled = ((counts - counts.min()) / (counts.max() - counts.min()) * 100).round(2)
    expected = sorted((c, y, m, v) for (c, y, m), v in scaled.items())
    assert sorted(tuple(r) for r in metrics.activity_score_scaled(log).collect()) == expected


def test_scaled_activity_is_nan_if_all_are_equal(spark):
    log = landed(spark, "actions", [(c, K.CASH_IN, at("2024-01-05"), money(1), "NA") for c in (1, 2)])
    assert all(math.isnan(r["ACTIVITY_SCORE"]) for r in metrics.activity_score_scaled(log).collect())


def test_metrics_read_text_times(spark):
    log = spark.createDataFrame(
        [(1, K.FUND_BUY, "09.00-05.01.24", money(2), "F01"), (1, K.FUND_BUY, "N/A", money(2), "F01")],
        "customer_id bigint, action_type string, timestamp string, amount decimal(18,2), fund_code string",
    )
    assert rows(metrics.transaction_volume_pd(log)) == [(1, 2024, 1, money(2))]
    views = spark.createDataFrame(
        [(1, "open", "F01", "09.00.30-05.01.24"), (1, "open", "F01", "09.00-05.01.24")],
        "customer_id bigint, action_type string, fund_code string, timestamp string",
    )
    assert rows(metrics.fund_clicks_pd(views)) == [(1, 2024, 1, "F01", 1)]


def test_hour_percentages(spark):
    log = landed(
        spark,
        "actions",
        [(1, K.CASH_IN, at(f"2024-01-{d:02} 08:00:00"), money(1), "NA") for d in range(1, 32)]
        + [(1, K.CASH_IN, at("2024-01-05 23:00:00"), money(1), "NA")],
    )
    # 1 of 32 is 3.125, a half that goes to the even neighbour.
    assert rows(metrics.hour_bucket_pct(log)) == [(1, 2024, 1, "96.88%", "0.00%", "0.00%", "3.12%")]


def test_idle_months_are_filled_only_if_a_bucket_is_absent(spark):
    log = landed(
        spark,
        "actions",
        [
            (1, K.CASH_IN, at("2024-01-05 08:00:00"), money(1), "NA"),
            (2, K.CASH_IN, at("2023-02-05 08:00:00"), money(1), "NA"),
        ],
    )
    zero = ("0%",) * 4
    full = ("100.00%", "0.00%", "0.00%", "0.00%")
    assert rows(metrics.hour_bucket_pct(log, fill_missing=True)) == sorted(
        [
            (1, 2023, 1, *zero), (1, 2023, 2, *zero), (1, 2024, 1, *full), (1, 2024, 2, *zero),
            (2, 2023, 1, *zero), (2, 2023, 2, *full), (2, 2024, 1, *zero), (2, 2024, 2, *zero),
        ],
        key=str,
    )
    complete, _ = random_log(spark)
    assert rows(metrics.hour_bucket_pct(complete, fill_missing=True)) == rows(
        metrics.hour_bucket_pct(complete)
    )


def test_filled_months_are_neither_shuffled_nor_held(spark):
    """The lists of months are opened last; no row that was filled in meets an aggregate or a shuffle."""
    log = landed(
        spark,
        "actions",
        [
            (1, K.CASH_IN, at("2024-12-05 08:00:00"), money(1), "NA"),
            (None, K.CASH_IN, at("2023-01-05 08:00:00"), money(1), "NA"),
            (None, K.CASH_IN, at("2023-01-06 23:00:00"), money(1), "NA"),
        ],
    )
    found = metrics.hour_bucket_pct(log, fill_missing=True)
    zero, full, half = ("0%",) * 4, ("100.00%", "0.00%", "0.00%", "0.00%"), ("50.00%", "0.00%", "0.00%", "50.00%")
    assert rows(found) == sorted(
        [
            (1, 2023, 1, *zero), (1, 2023, 12, *zero), (1, 2024, 1, *zero), (1, 2024, 12, *full),
            (None, 2023, 1, *half), (None, 2023, 12, *zero), (None, 2024, 1, *zero), (None, 2024, 12, *zero),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    plan = found._jdf.queryExecution().sparkPlan().toString()
    above, opened, _ = plan.partition("Generate inline")
    assert opened and "Aggregate" not in above and "Union" not in plan


def test_row_ratios_follow_floating_point(spark):
    table = landed(
        spark,
        "monthly_outstandings",
        [(n, "2024/01", money(a), money(f)) for n, (a, f) in enumerate([(4, 1), (0, 1), (0, -1), (0, 0)])],
    )
    found = [r["FUND_BALANCE_RATIO"] for r in metrics.fund_balance_ratio_rows(table).collect()]
    assert found[:3] == [0.25, math.inf, -math.inf] and math.isnan(found[3])


@pytest.mark.parametrize("seed", range(3))
def test_daily_trend_equals_pandas(spark, seed):
    rng = random.Random(seed)
    data = []
    for customer in range(6):
        for offset in sorted(rng.sample(range(60), 20)):
            value = None if rng.random() < 0.2 else money(rng.randrange(5))
            data.append((customer, value, money(0), day("2024-01-01") + timedelta(days=offset)))
    table = pd.DataFrame(data, columns=["c", "v", "f", "d"])
    table["v"], table["d"] = table.v.astype(float), pd.to_datetime(table.d)
    keys = [table.c, table.d.dt.year.rename("y"), table.d.dt.month.rename("m")]
    change = table.v.groupby(keys).diff().fillna(0)
    sums = change.groupby(keys).sum()
    expected = [(c, y, m, (v > 0) - (v < 0)) for (c, y, m), v in sums.items()]
    found = metrics.outstanding_trend_diff(landed(spark, "daily_outstandings", data))
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_unknown_funds_in_risks(spark):
    funds = landed(spark, "fund_details", [("F01", 5, "c", "a")])
    when = at("2024-01-05")
    views = landed(
        spark, "fund_actions", [(1, "open", "F01", when), (1, "open", "F99", when), (1, "open", "F99", when), (1, "back", "F01", when)]
    )
    assert rows(metrics.interested_fund_risk_pd(views, funds)) == [(1, 2024, 1, 1.67)]
    assert rows(metrics.interested_fund_count_pd(views)) == [(2024, 1, "open", 3)]
    holdings = landed(
        spark,
        "monthly_outstanding_funds",
        [(1, "2024/01", "F01", money(1)), (1, "2024/01", "F99", money(2)), (2, "2024/01", "F01", money(0))],
    )
    first, second = metrics.owned_fund_risk_pd(holdings, funds).orderBy("CUST_ID").collect()
    assert first["OWNED_FUND_RISK"] == 1.67 and math.isnan(second["OWNED_FUND_RISK"])
    assert rows(metrics.owned_fund_count_pd(holdings), "CUST_ID", "OWNED_FUND_COUNT") == [(1, 2), (2, 1)]


def test_fingerprint_sees_content_and_keyword_but_not_order(spark):
    table = spark.createDataFrame([(1, "a,b"), (2, None), (2, None)], "x bigint, y string")
    changed = spark.createDataFrame([(1, "a"), (2, "b"), (2, None)], "x bigint, y string")
    prints = [
        rows(metrics.table_fingerprint(df, key))
        for df, key in [
            (table, "k"),
            (table.repartition(3).orderBy("x", ascending=False), "k"),
            (table, "other"),
            (changed, "k"),
        ]
    ]
    assert prints[0] == prints[1] and len({str(p) for p in prints}) == 3
