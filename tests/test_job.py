import re
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from folioscope.plans.daily import DailyRun, Warehouse, months_between, run_daily
from folioscope.plans.landing import Landing
from folioscope.operators import paths
from folioscope import schemas
from folioscope.plans import summaries, upkeep
from folioscope.session import shared_dir
from folioscope.sinks import state as job_state
from folioscope.sinks import tables, versions
from folioscope.sinks.tables import read_table, upload_log, write_table
from folioscope.sources.sample import SampleSources
from tests.frames import at, landed, rows


def test_repeated_loads_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,), (2,)], "x int")
    two = spark.createDataFrame([(3,)], "x int")
    assert write_table(one, path, "append", "a") == 2
    assert write_table(two, path, "append", "b") == 1
    assert write_table(two, path, "append", "b") == 1
    assert rows(read_table(spark, path), "x") == [(1,), (2,), (3,)]
    assert write_table(two, path, "append", "c", restart=True) == 1
    assert rows(read_table(spark, path), "x") == [(3,)]
    assert write_table(one, path, "replace") == 2
    assert rows(read_table(spark, path), "x") == [(1,), (2,)]
    with pytest.raises(ValueError):
        write_table(one, path, "append")


def test_a_replacement_that_breaks_off_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = spark.range(40).selectExpr("id AS x")
    write_table(old, path)
    new = spark.range(0, 4000, 1, 8).selectExpr("id AS x")
    breaks = new.selectExpr("CASE WHEN x = 3999 THEN raise_error('lost') ELSE x END AS x")
    with pytest.raises(Exception, match="lost"):
        write_table(breaks, path)
    assert rows(read_table(spark, path)) == rows(old)
    with monkeypatch.context() as patched:  # the run ends between the last row and the switch
        patched.setattr(tables, "switch_version", lambda *_: pytest.fail("ended"))
        with pytest.raises(pytest.fail.Exception, match="ended"):
            write_table(new, path)
    assert rows(read_table(spark, path)) == rows(old)
    reader = read_table(spark, path)  # begun before the switch
    assert write_table(new, path) == 4000
    assert read_table(spark, path).count() == 4000 and reader.count() == 40
    left = lambda: {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert len(left()) == 2 and versions.current_version(spark, path) in left()
    assert write_table(old, path) == 40
    assert len(left()) == 2 and rows(read_table(spark, path)) == rows(old)
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_file() and p.suffix != ".crc") == ["_current"]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5).selectExpr("id AS x", "'k' AS k", "1 AS y"), path, "append", "a", ["k"])
    twice = read_table(spark, path).selectExpr("x * 2 AS x", "k", "y")
    assert write_table(twice, path, partition_by=["k"]) == 5
    found = read_table(spark, path)
    assert found.columns == ["x", "k", "y"] and rows(found, "x") == [(0,), (2,), (4,), (6,), (8,)]
    assert write_table(twice.limit(0), path, partition_by=["k"]) == 0
    assert read_table(spark, path).columns == ["x", "k", "y"] and read_table(spark, path).count() == 0


def test_a_plain_folder_is_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert read_table(spark, path).count() == 3
    assert write_table(spark.range(7), path) == 7
    assert read_table(spark, path).count() == 7


def test_upload_log_keeps_the_newest_count(spark):
    entries = spark.createDataFrame(
        [
            (date(2024, 1, 1), "a", 5, at("2024-01-01 10:00:00")),
            (date(2024, 1, 1), "a", 3, at("2024-01-01 12:00:00")),
            (date(2024, 1, 1), "b", 1, at("2024-01-01 12:00:00")),
        ],
        "log_date date, table_name string, row_count bigint, logged_at timestamp_ntz",
    )
    assert rows(upload_log(entries)) == [(date(2024, 1, 1), "a", 3), (date(2024, 1, 1), "b", 1)]


def test_windows_follow_the_state():
    today = date(2024, 1, 31)
    first = job_state.next_window(None, today)
    assert (first.start, first.end, first.initial) == (date(2000, 1, 1), today, True)
    state = {"latest": "2024-01-10", "initial_run": False, "end_date": "2024-01-20"}
    assert job_state.next_window(state, today).end == date(2024, 1, 20)
    assert not job_state.next_window(state, today).initial
    bad = job_state.next_window({"latest": "x", "end_date": "31.01.2024"}, today)
    assert (bad.start, bad.end) == (date(2000, 1, 1), today)
    behind = job_state.next_window({"latest": "2024-01-25", "end_date": "2024-01-20"}, today)
    assert behind.start == behind.end == date(2024, 1, 25)


def test_state_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    assert job_state.read_state(spark, path) is None
    window = job_state.next_window(None, date(2024, 1, 10))
    job_state.write_state(spark, path, window)
    window = job_state.next_window(job_state.read_state(spark, path), date(2024, 1, 12))
    assert (window.start, window.end, window.initial) == (date(2024, 1, 10), date(2024, 1, 12), False)
    job_state.write_state(spark, path, window)
    assert job_state.read_state(spark, path)["latest"] == "2024-01-12"


def test_state_reads_a_plain_json_file(spark, tmp_path):
    file = tmp_path / "state.json"
    file.write_text('{\n  "latest": "2024-01-10",\n  "initial_run": false,\n  "end_date": "2024-01-20"\n}')
    window = job_state.next_window(job_state.read_state(spark, str(file)), date(2024, 1, 31))
    assert (window.start, window.end, window.initial) == (date(2024, 1, 10), date(2024, 1, 20), False)


def files_of(root, name):
    """Data files by partition folder, with what a rewrite would change."""
    folder = root / name
    found = defaultdict(set)
    for file in folder.rglob("part-*.parquet"):
        found[str(file.parent.relative_to(folder))].add((file.name, file.stat().st_mtime_ns))
    return dict(found)


def test_two_daily_runs_equal_one_plan_over_both_windows(spark, tmp_path):
    sources = SampleSources(spark, contract.SMOKE_DIR)
    folder = tmp_path / "warehouse"
    root = str(folder)
    counts = run_daily(spark, sources, root, date(2024, 1, 16), buckets=64)
    assert all(counts[name] > 0 for name in ("actions", "arketip", "out_path_4_events"))
    last = date(2024, 1, 31)
    warehouse = Warehouse(spark, root)
    previous = spark.createDataFrame(warehouse.matrix().collect(), warehouse.matrix().schema)
    kept = ("summary_year_month", "summary_year_month_fund_based", "arketip")
    before = {name: files_of(folder, name) for name in kept}
    run_daily(spark, sources, root, last, datetime(2024, 1, 31, 6), buckets=64)

    whole = Landing(sources, date(2000, 1, 1), last, last)
    for name in ("digital_actions", "daily_outstandings", "actions", "monthly_outstandings",
                 "monthly_outstanding_funds", "member_details", "bias_results", "fund_actions"):
        expected = getattr(whole, name)
        assert rows(getattr(warehouse, name), *expected.columns) == rows(expected), name

    newest = Landing(sources, date(2024, 1, 16), last, last)
    assert whole.fund_actions.count() > newest.fund_actions.count() > 0

    # What was brought up to date equals what a full build gives.
    fund = summaries.summary_year_month_fund(warehouse)
    assert rows(warehouse.read("summary_year_month_fund_based")) == rows(fund)
    assert rows(warehouse.read("summary_year_month")) == rows(summaries.summary_year_month(warehouse))
    matrix = warehouse.matrix()
    expected = summaries.arketip(warehouse, last, previous)
    assert rows(matrix, *expected.columns) == rows(expected)
    process = summaries.digital_process(warehouse, last)
    assert rows(warehouse.read("out_path_4_events")) == rows(paths.out_path_4_events(process))

    # And nothing else was written: the files of other months and buckets are the same.
    for name in kept[:2]:
        after = files_of(folder, name)
        assert all("year=2024/month=1" in part for part in after if after[part] != before[name].get(part))
        assert sum(after[part] == before[name].get(part) for part in after) >= 2
    after = files_of(folder, "arketip")
    assert 0 < sum(after[part] == before["arketip"].get(part) for part in after) < len(after)
    log = {r["table_name"]: r["row_count"] for r in warehouse.log().filter("log_date = DATE '2024-01-31'").collect()}
    assert log["arketip"] == matrix.count() and log["member_details"] == warehouse.member_details.count()
    assert warehouse.log().count() == 2 * len(log)


def partition_filters(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", df._jdf.queryExecution().explainString(mode))


def test_landed_history_is_pruned_by_day(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for name, column in schemas.DAY_OF.items():
        times = [at("2023-01-05 10:00:00"), at("2023-07-30 23:59:59"), at("2023-07-31 00:00:00"), at("2024-01-30 12:00:00"), None]
        fields = {f.name: None for f in schemas.LANDED[name].fields}
        table = [tuple({**fields, "customer_id": 1, column: t if column != "date" or t is None else t.date()}.values()) for t in times]
        df = landed(spark, name, table).withColumn(schemas.DAY, F.to_date(column))
        write_table(df, warehouse.path(name), mode="append", load="from-2000-01-01", partition_by=[schemas.DAY])
        assert getattr(warehouse, name).count() == 5
        since = warehouse.since(name, date(2023, 7, 31))
        assert since.count() == 2 and "event_day" in partition_filters(since)[0]
    process = summaries.digital_process(warehouse, date(2024, 1, 31))
    filters = partition_filters(process)
    assert len(filters) == 2 and all("(event_day" in f and ">= 2023-07-31)" in f for f in filters)
    months = warehouse.of_months(["2023/07"])
    assert months.daily_outstandings.count() == 2 and "event_day" in partition_filters(months.actions)[0]
    window = job_state.next_window({"latest": "2023-07-31", "initial_run": False}, date(2024, 1, 31))
    slice_ = job_state.incremental_slice(warehouse.read("actions"), "timestamp", window, schemas.DAY)
    assert slice_.count() == 2 and "event_day" in partition_filters(slice_)[0]


def test_a_repeated_load_replaces_days_it_no_longer_has(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "x int, day date")
    write_table(df, path, "append", "a", ["day"])
    write_table(df, path, "append", "b", ["day"])
    assert write_table(df.filter("x = 2"), path, "append", "a", ["day"]) == 1
    found = read_table(spark, path)
    assert rows(found, "x", "load") == [(1, "b"), (2, "a"), (2, "b")]
    assert found.columns == ["x", "day", "load"]


def test_only_changed_buckets_are_read_and_merged(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    table = spark.range(100).selectExpr("id AS customer_id", "id AS v").withColumn("bucket", upkeep.bucket_of("customer_id", 8))
    write_table(table, warehouse.path("arketip"), mode="partitions", partition_by=["bucket"])
    two = warehouse.matrix([3, 5])
    assert "bucket" in partition_filters(two)[0] and rows(two, "v") == rows(table.filter("bucket IN (3, 5)"), "v")
    merged = warehouse.matrix([3, 5]).withColumn("v", F.col("v") + 1000).filter("bucket = 3")
    write_table(merged, warehouse.path("arketip"), mode="partitions", partition_by=["bucket"], covered=[(3,), (5,)])
    want = table.filter("bucket <> 5").selectExpr("CASE WHEN bucket = 3 THEN v + 1000 ELSE v END AS v")
    assert rows(warehouse.matrix(), "v") == rows(want)


def test_what_a_run_touches_follows_from_what_changed(spark):
    def table(name, *values):
        fields = [f.name for f in schemas.LANDED[name].fields]
        return landed(spark, name, [tuple((dict.fromkeys(fields) | v).values()) for v in values])

    def marks(snapshot, details, funds, popular, setup="2024"):
        found = upkeep.fingerprints(
            table("actions", *snapshot), {"member_details": table("member_details", *details)},
            table("fund_details", *funds), table("popular_funds", *popular), setup, 8,
        )
        return spark.createDataFrame(found.collect(), found.schema)

    joined = {"customer_id": 1, "action_type": "a", "timestamp": at("2023-05-01 00:00:00")}
    later = {"customer_id": 2, "action_type": "a", "timestamp": at("2023-09-01 00:00:00")}
    nobody = {"customer_id": None, "timestamp": None}
    who, fund, day = {"customer_id": 1, "birth_year": 1980}, {"code": "F1", "risk_value": 3}, {"fund_code": "F1"}
    old = marks([joined, nobody], [who], [fund], [day])
    bucket = {n: spark.range(n, n + 1).select(upkeep.bucket_of("id", 8)).first()[0] for n in (1, 2)}
    assert upkeep.changes(old, None) is None
    assert upkeep.months_to_build(None, ["2024/01"]) is None and upkeep.buckets_to_build(None, [1]) is None
    assert upkeep.changes(marks([nobody, joined], [who], [fund], [day]), old) == set()
    assert upkeep.months_to_build(set(), ["2024/01"]) == ["2024/01"]
    more = upkeep.changes(marks([joined, later, nobody], [who], [fund], [day]), old)
    assert upkeep.months_to_build(more, ["2024/01"]) == ["2023/09", "2024/01"]
    assert upkeep.buckets_to_build(more, [7]) == sorted({bucket[2], 7})
    gone = upkeep.changes(marks([nobody], [], [fund], [day]), old)
    assert upkeep.months_to_build(gone, []) == ["2023/05"] and upkeep.buckets_to_build(gone, []) == [bucket[1]]
    riskier = upkeep.changes(marks([joined, nobody], [who], [fund | {"risk_value": 4}], [day]), old)
    assert upkeep.months_to_build(riskier, []) is None and upkeep.buckets_to_build(riskier, []) is None
    renamed = upkeep.changes(marks([joined, nobody], [who], [fund | {"category": "x"}], [day]), old)
    assert upkeep.months_to_build(renamed, []) == [] and upkeep.buckets_to_build(renamed, []) is None
    year = upkeep.changes(marks([joined, nobody], [who], [fund], [day], "2025"), old)
    assert upkeep.months_to_build(year, []) == [] and upkeep.buckets_to_build(year, []) is None


def test_a_run_repeated_after_a_lost_state_adds_nothing(spark, tmp_path):
    sources = SampleSources(spark, contract.SMOKE_DIR)
    root = str(tmp_path / "warehouse")
    first = run_daily(spark, sources, root, date(2024, 1, 31), buckets=8)
    before = {name: rows(Warehouse(spark, root).read(name)) for name in ("actions", "digital_actions")}
    # The state was never read back: the window is the same again.
    again = DailyRun(spark, sources, root, date(2024, 1, 31), datetime(2024, 1, 31), buckets=8)
    again.window = job_state.next_window({"latest": "2000-01-01", "initial_run": False}, date(2024, 1, 31))
    assert again.run() == first
    after = {name: rows(Warehouse(spark, root).read(name)) for name in before}
    assert after == before


def test_an_empty_load_replaces_an_earlier_one(spark, tmp_path):
    path = str(tmp_path / "table")
    two = spark.createDataFrame([(1,), (2,)], "a int")
    assert write_table(two, path, mode="append", load="one") == 2
    assert write_table(two, path, mode="append", load="two") == 2
    assert write_table(two.limit(0), path, mode="append", load="one") == 0
    assert rows(read_table(spark, path), "a", "load") == rows(two.selectExpr("a", "'two' AS load"))


def test_a_covered_month_without_rows_is_removed(spark, tmp_path):
    path = str(tmp_path / "table")
    month = spark.createDataFrame([(1, "2023/12"), (2, "2024/01"), (3, "2024/02")], "a int, year_month string")
    by_month = {"mode": "partitions", "partition_by": ["year_month"]}
    assert write_table(month, path, **by_month) == 3
    again = month.filter("a = 3")
    assert write_table(again, path, covered=["2024/01", "2024/02"], **by_month) == 1
    assert rows(read_table(spark, path), "a", "year_month") == [(1, "2023/12"), (3, "2024/02")]
    assert write_table(again.limit(0), path, covered=["2024/02"], **by_month) == 0
    assert rows(read_table(spark, path), "a", "year_month") == [(1, "2023/12")]


def test_months_of_a_window():
    assert months_between(date(2023, 11, 1), date(2024, 2, 1)) == ["2023/11", "2023/12", "2024/01"]
    assert months_between(date(2024, 1, 1), date(2024, 1, 2)) == ["2024/01"]
    assert months_between(date(2024, 1, 1), date(2024, 1, 1)) == []


def test_legacy_runs_keep_the_newest_fund_views(spark, tmp_path):
    sources = SampleSources(spark, contract.SMOKE_DIR)
    root, last = str(tmp_path / "warehouse"), date(2024, 1, 31)
    for as_of in (date(2024, 1, 16), last):
        DailyRun(spark, sources, root, as_of, datetime(2024, 1, 31), legacy_views=True, buckets=8).run()
    newest = Landing(sources, date(2024, 1, 16), last, last)
    assert rows(Warehouse(spark, root).fund_actions) == rows(newest.fund_actions)


def test_a_run_without_new_rows_gives_empty_tables(spark, tmp_path):
    sources = SampleSources(spark, contract.SMOKE_DIR)
    root = str(tmp_path / "warehouse")
    counts = run_daily(spark, sources, root, date(2001, 1, 1), buckets=8)
    assert counts["digital_actions"] == counts["summary_year_month"] == 0
    assert counts["member_details"] == counts["arketip"] > 0


def test_scratch_lies_in_the_shared_folder(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
