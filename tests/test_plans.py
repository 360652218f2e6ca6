"""What the plans must and must not contain."""

import re
from functools import cache

import pytest

import __spark_entry__ as contract
from folioscope.functions.joins import SALTS, heavy_keys, salted_join
from folioscope.plans.catalog import AS_OF, END, MID, MID_AS_OF, QUERIES, START, Fixture
from folioscope.operators import features, members, monthly, paths
from folioscope.operators.events import digital_actions
from folioscope.sources.sample import SampleSources
from tests.frames import at, landed


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    @cache
    def plan(name):
        return plan_of(contract.queries()[name](spark, contract.SMOKE_DIR))

    return plan


@pytest.mark.parametrize("name", sorted(set(QUERIES)))
def test_no_python_and_no_cross_join(plans, name):
    found = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas|ArrowEval", plans(name))
    assert not found


def exchanges(plan: str) -> list[set[str]]:
    """The column names each shuffle hashes by."""
    found = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    return [set(re.findall(r"([A-Za-z_]\w*)#", columns)) for columns in found]


@pytest.fixture(scope="module")
def shuffled(spark):
    """Plans as they are when no side is small enough to broadcast."""

    @cache
    def plan(name):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return plan_of(contract.queries()[name](spark, contract.SMOKE_DIR))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    return plan


def test_no_join_is_forced_to_broadcast(shuffled):
    """With Spark's own threshold off, only lists cut to a fixed length are still broadcast."""
    for name in ("arketip", "summary_year_month", "fund_actions", "event_groups"):
        assert "BroadcastHashJoin" not in shuffled(name)
    for name in ("out_path_4_events", "prior_events"):
        lines = shuffled(name).splitlines()
        sent = [k for k, line in enumerate(lines) if "BroadcastExchange" in line]
        below = [next(x for x in lines[k + 1 :] if not re.search(r"- (Project|Filter) ", x)) for k in sent]
        assert sent and all("TakeOrderedAndProject(limit=10000" in x for x in below)


def ran(spark, df) -> str:
    """The plan that ran in the end, with nothing broadcast by size."""
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for limit in limits:
        spark.conf.set(limit, "-1")
    try:
        df.collect()
    finally:
        for limit in limits:
            spark.conf.unset(limit)
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name, most", [("event_groups", 4), ("event_prev", 3)])
def test_histories_are_read_once_and_shuffled_in_chunks(spark, tmp_path, name, most):
    """One shuffle of the rows by customer and day, used twice; further ones move a row per chunk or customer."""
    fixture = Fixture(spark, contract.SMOKE_DIR)
    fixture.stored_process.write.parquet(f"{tmp_path}/process")
    process = spark.read.parquet(f"{tmp_path}/process")
    if name == "event_prev":
        df = paths.event_prev(process)
    else:
        df = paths.event_groups(process, paths.conversion_occurrences(process))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ran(spark, df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall("ReusedExchange", plan)) >= 1
    plan = re.sub(r"ReusedExchange[^\n]*", "", plan)
    own = exchanges(re.sub(r"Exchange hashpartitioning\(event_field[^\n]*", "", plan))  # of three literal rows
    assert len(own) <= most and {"customer_id", "__chunk"} in own
    assert len(re.findall("FileScan parquet", plan)) <= (2 if name == "event_groups" else 1)
    assert not re.search(r"Window [^\n]*\[event_type|Exchange hashpartitioning\(customer_id#\d+L, event", plan)


def test_salts_follow_the_rows_of_a_key(spark):
    """Of two heavy keys the one with four times the rows is dealt to four times the tasks."""
    hot = "CASE WHEN id % 20 < 12 THEN 1 WHEN id % 20 < 15 THEN 2 ELSE id END AS k"
    large = spark.range(8000).selectExpr(hot, "id AS v")
    small = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (2, 'c'), (3999, 'd'), (1000000, 'e') AS t(k, w)")
    small = small.selectExpr("CAST(k AS BIGINT) AS k", "w")
    found = salted_join(large, small, "k", ["v"], target=100)
    want = large.join(small, "k")
    assert found.count() == want.count() and found.exceptAll(want).isEmpty()
    salts = {r["k"]: r[SALTS] for r in heavy_keys(large, "k", 100).collect()}
    assert salts == {1: 48, 2: 12}
    assert {r["k"]: r[SALTS] for r in heavy_keys(large.limit(4000), "k", 100, most=1).collect()}.keys() <= {1, 2}
    few = [r[0] for r in heavy_keys(large, "k", 10_000).collect()]
    assert few == [] and salted_join(large, small, "k", ["v"]).count() == want.count()


def test_balances_are_read_once(shuffled):
    plan = shuffled("monthly_outstandings")
    assert len(re.findall(r"FileScan parquet[^\n]*lineitem", plan)) == 1
    assert re.search(r"WindowGroupLimit[^\n]*Partial", plan)


def test_sample_filters_before_it_sorts(spark):
    """A draw of 20 of 20,000: what is sorted is hardly more than the sample."""
    members_table = spark.range(20_000).selectExpr(
        "id AS serno", "'A' AS status", "'named' AS account_type", "TIMESTAMP_NTZ '2023-01-01 00:00:00' AS registration_time",
        "'1' AS mobile_number_verified", "CAST(NULL AS TIMESTAMP_NTZ) AS account_ready_time",
    )
    sample = members.members_without_account_sample(members_table, 20)
    drawn = members_table.selectExpr("serno", "md5(concat('42:', CAST(serno AS STRING))) AS d").orderBy("d").limit(20)
    assert [r[0] for r in sample.collect()] == [r[0] for r in drawn.collect()]
    plan = plan_of(sample)
    assert re.search(r"TakeOrderedAndProject\(limit=20", plan) and re.search(r"Filter [^\n]*substring[^\n]*ubquery", plan)
    head = drawn.agg({"d": "max"}).first()[0][:4]
    below = members_table.filter(f"substring(md5(concat('42:', CAST(serno AS STRING))), 1, 4) <= '{head}'")
    assert 20 <= below.count() <= 25


def test_daily_trend_reads_the_balances_once_and_windows_over_days(shuffled):
    plan = shuffled("outstanding_trend_diff")
    assert {"CUST_ID", "YEAR", "MONTH"} in exchanges(plan)
    assert len(re.findall(r"HashAggregate[^\n]*partial_min\(account_volume", plan)) == 1
    assert "__chunk" not in plan


def test_activity_score_has_one_scalar(shuffled):
    """Lowest and highest in one subquery, that all other places refer to."""
    plan = shuffled("activity_score_scaled")
    assert len(set(re.findall(r"scalar-subquery#(\d+)|[Ss]ubquery#(\d+)", plan))) == 1


def test_paths_are_aggregated_in_spread_groups(shuffled):
    """The join by customer must not decide the partitions of what follows."""
    plan = shuffled("out_path_4_events")
    assert {"customer_id", "__salt"} in exchanges(plan)
    assert {"customer_id", "seq", "event_type"} in exchanges(plan)
    # By customer alone only counts per customer travel.
    for found in re.finditer(r"Exchange hashpartitioning\(customer_id#\d+L?, \d+\)[^\n]*\n[^\n]*", plan):
        assert "partial_count(1)" in found[0]


def test_spark_can_split_a_hot_member(spark):
    """Joins of events with members are followed by a shuffle anyway, so AQE may split them."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "4k",
    }
    events = spark.createDataFrame(
        [(1 if n % 3 else n, "settings", "click", "x", at("2024-01-05 10:00:00")) for n in range(3000)],
        "member_serno bigint, view_name string, activity string, details string, t timestamp_ntz",
    ).selectExpr("*", "t AS client_time", "t AS server_time").repartition(8)
    ids = spark.range(3000).selectExpr("id AS member_serno", "id + 5000000 AS customer_id")
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        landed_events = digital_actions(events, ids, "2024-01-01", "2024-02-01")
        found = features.event_features(landed_events, ["settings"])
        counts = {r["customer_id"]: r["settings"] for r in found.collect()}
        plan = plan_of(found)
    finally:
        for key in small:
            spark.conf.unset(key)
    assert counts[5000001] == 2000 and len(counts) == 1001
    assert "SortMergeJoin(skew=true)" in plan


def test_top_n_is_limited_before_the_shuffle(shuffled):
    for name in ("last_3_events", "out_path_4_events", "otonombuy", "monthly_outstandings"):
        assert re.search(r"WindowGroupLimit[^\n]*Partial", shuffled(name))


def test_literal_tables_are_known_to_be_small(plans):
    """The few conversion events travel to the events, not the other way round."""
    plan = plans("conversion_occurrences")
    assert re.search(r"BroadcastExchange[^\n]*\n[^\n]*LocalTableScan \[seq", plan)
    assert "ExistingRDD" not in plan


def test_filters_and_columns_reach_the_scan(plans):
    fund_views = plans("fund_actions")
    assert "GreaterThanOrEqual(ts,2023-11-01T00:00)" in fund_views
    bought = plans("faiz_okey")
    assert "c_name" not in bought and "c_mktsegment" not in bought


def test_matrix_reads_each_landed_table_once_or_twice(spark, tmp_path):
    """Events and actions once for the marks and once for the strategy pairs."""
    names = ["digital_actions", "actions", "fund_actions", "member_details", "bias_results",
             "monthly_outstanding_funds", "fund_details", "popular_funds"]
    root = tmp_path
    for n in names:
        landed(spark, n, []).write.parquet(f"{root}/{n}")
    read = [spark.read.parquet(f"{root}/{n}") for n in names]
    plan = plan_of(features.feature_updates(*read, "2024-01-31"))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    # Twice events, actions and the fund dimension; the other five tables once.
    assert len(scans) == 11
    assert sum("event_time" in columns for columns in scans) == 2
    assert not any("occupation" in columns or "amount" in columns for columns in scans)


def test_summary_joins_add_no_shuffle(shuffled, plans):
    """Five groupings, five shuffles on the keys; the joins find them in place."""
    for plan in (shuffled("summary_year_month"), plans("summary_year_month")):
        by_key = [k for k in exchanges(plan) if {"year", "month"} <= k]
        assert by_key == [{"customer_id", "year", "month"}] * 5


@pytest.mark.parametrize("name", ["summary_year_month", "summary_year_month_by_month", "feature_merge_by_bucket"])
def test_windows_share_what_has_none(spark, monkeypatch, name):
    """Balances and cancelled orders are derived once, whatever the tables and windows that read them."""
    asked = []
    view = SampleSources.__getitem__
    monkeypatch.setattr(SampleSources, "__getitem__", lambda self, name: asked.append(name) or view(self, name))
    QUERIES[name](Fixture(spark, contract.SMOKE_DIR))
    assert asked.count("fund_orders") == asked.count("serno_mapping") == 1
    assert asked.count("eod_accounts") == (0 if name == "feature_merge_by_bucket" else 1)


@pytest.mark.parametrize("table", ["monthly_outstandings", "monthly_outstanding_funds"])
def test_month_conditions_stay_off_the_scan(spark, table):
    """No balance has its month formed as a text and parsed to see whether it is one."""
    held = getattr(Fixture(spark, contract.SMOKE_DIR).landed, table)
    found = monthly.ym_volumes(held) if table == "monthly_outstandings" else monthly.ym_owned_fund_count(held)
    filters = re.findall(r"Filter [^\n]*RLIKE[^\n]*", found._jdf.queryExecution().optimizedPlan().toString())
    assert len(filters) == 1 and "l_orderkey" not in filters[0]


def test_a_month_is_built_from_its_own_days(spark, monkeypatch):
    """The month built anew asks for a window of that month, not for a whole one to be cut afterwards."""
    windows = []
    landing = Fixture.landing
    monkeypatch.setattr(Fixture, "landing", lambda self, *window: windows.append(window) or landing(self, *window))
    QUERIES["summary_year_month_by_month"](Fixture(spark, contract.SMOKE_DIR))
    assert windows == [(START, MID, MID_AS_OF), (MID.replace(day=1), END, AS_OF)]
