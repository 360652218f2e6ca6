import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions.ordered import numbered_runs, previous_value, running_total
from folioscope.operators import path_state, paths
from tests.frames import at, landed, money, rows

AS_OF = date(2024, 1, 31)
DEPOSIT = "account - click - deposit"


def process_of(spark, events, actions=()):
    formatted = paths.digital_formatted(landed(spark, "digital_actions", list(events)), AS_OF)
    return paths.digital_process(formatted, landed(spark, "actions", list(actions)), AS_OF)


def event(customer, name, when):
    return (customer, *name.split(" - "), at(when))


def test_event_name_stops_at_the_first_comma_and_survives_nulls(spark):
    events = landed(
        spark,
        "digital_actions",
        [
            (1, "home", "click", "a,b,c", at("2024-01-01")),
            (1, None, "click", None, at("2024-01-01")),
            (1, "old", "click", "a", at("2023-07-30 23:59:59")),
            (1, "edge", "click", "a", at("2023-07-31")),
        ],
    )
    found = paths.digital_formatted(events, AS_OF)
    assert rows(found, "event_field", "details_aft_comma") == [
        (" - click - ", None),
        ("edge - click - a", ""),
        ("home - click - a", "b"),
    ]


def test_ignored_events_are_left_out(spark):
    when = "2024-01-05 10:00:00"
    kept = process_of(
        spark,
        [
            event(1, "home - click - CHARTS", when),
            event(1, "signIn - click - auto login", when),
            event(1, "settings - click - Çıkış Yap", when),
            event(1, "home - click - x", when),
        ],
    )
    assert rows(kept, "event_field") == [("home - click - x",)]
    formatted = paths.digital_formatted(
        landed(spark, "digital_actions", [event(1, "home - click - CHARTS", when)]), AS_OF
    )
    listed = {r[0] for r in rows(paths.ignored_events(formatted))}
    assert listed == {*K.IGNORED_EVENTS, "home - click - CHARTS"}


def test_actions_join_the_process_with_rounded_amounts(spark):
    log = [
        (1, K.FUND_BUY, at("2024-01-05 10:30:00"), money(2.5), "F01"),
        (1, K.FUND_BUY, None, money(1), "F01"),
        (1, K.FUND_BUY, at("2023-07-30 10:30:00"), money(1), "F01"),
    ]
    found = process_of(spark, [], log)
    assert rows(found, "source", "event_field", "event_data_text", "event_data_num") == [
        ("transaction", K.FUND_BUY, "F01", 3)
    ]


def test_clock_reads_hours_and_minutes_unless_legacy(spark):
    formatted = paths.digital_formatted(landed(spark, "digital_actions", []), AS_OF)
    log = spark.createDataFrame(
        [(1, K.FUND_BUY, "02.30-05.01.24", money(1), "F01"), (1, K.FUND_BUY, "N/A", money(1), "F01")],
        "customer_id bigint, action_type string, timestamp string, amount decimal(18,2), fund_code string",
    )
    plain = paths.digital_process(formatted, log, AS_OF)
    legacy = paths.digital_process(formatted, log, AS_OF, legacy_clock=True)
    assert rows(plain, "converted_timestamp") == [(at("2024-01-05 02:30:00"),)]
    assert rows(legacy, "converted_timestamp") == [(at("2024-01-08 06:00:00"),)]


def test_equal_times_are_ordered_by_name(spark):
    when = "2024-01-05 10:00:00"
    process = process_of(
        spark,
        [
            event(1, "b - click - x", when),
            event(1, "a - click - x", when),
            event(1, "c - click - x", when),
            event(1, "d - click - x", when),
            event(1, DEPOSIT, "2024-01-05 11:00:00"),
        ],
    )
    path = paths.out_path_4_events(process)
    assert rows(path, "event_1", "event_2", "event_3", "event_4") == [
        ("a - click - x", "b - click - x", "c - click - x", DEPOSIT)
    ]


def test_conversion_without_a_predecessor_has_no_row(spark):
    process = process_of(spark, [event(1, DEPOSIT, "2024-01-05 11:00:00")])
    assert paths.out_path_4_events(process).count() == 0


def brute_force_paths(history):
    """Rank all pairs of an event and a later conversion, one customer after the other."""
    seqs = {f"{v} - {a} - {d}": seq for seq, v, a, d in K.CONVERSION_EVENTS}
    result = []
    for customer in {c for c, _, _ in history}:
        own = [(t, n) for c, n, t in history if c == customer]
        for seq in (1, 2, 3):
            ends = [(t, n) for t, n in own if seqs.get(n) == seq]
            newest = {}
            for end, _ in ends:
                for t, n in own:
                    if t < end:
                        newest[n] = max(newest.get(n, t), t)
            ranked = sorted(newest, key=lambda n: (-newest[n].timestamp(), n))[:3]
            if ranked:
                ranked += [None] * (3 - len(ranked))
                result += [(customer, seq, t, *ranked, n) for t, n in ends]
    return sorted(result, key=str)


def random_history(seed, customers=4, size=120):
    rng = random.Random(seed)
    names = ["home - click - x", "list - click - y", "find - click - z", "feed - click - w"]
    names += [f"{v} - {a} - {d}" for _, v, a, d in K.CONVERSION_EVENTS]
    start = at("2024-01-05 00:00:00")
    history = []
    for _ in range(size):
        # One customer has most of the rows; times repeat now and then.
        customer = 0 if rng.random() < 0.6 else rng.randrange(customers)
        history.append((customer, rng.choice(names), start + timedelta(minutes=rng.randrange(0, 600, 7))))
    return history


@pytest.mark.parametrize("seed", [1, 2])
def test_paths_equal_brute_force(spark, seed):
    history = random_history(seed)
    process = process_of(spark, [(c, *n.split(" - "), t) for c, n, t in history])
    columns = ["cust_id", "seq", "last_event_timestamp", "event_1", "event_2", "event_3", "event_4"]
    found = [tuple(r) for r in paths.out_path_4_events(process).select(*columns).collect()]
    assert sorted(found, key=str) == brute_force_paths(history)


@pytest.mark.parametrize("chunk", ["hour", "day"])
def test_chunked_windows_equal_plain_windows(spark, chunk):
    history = random_history(3, size=300)
    df = spark.createDataFrame(
        [(c, t, n, len(n) % 3) for c, n, t in history],
        "customer_id bigint, t timestamp_ntz, name string, value int",
    )
    part = W.partitionBy("customer_id")
    plain = df.withColumn("prev", F.lag("name").over(part.orderBy("t", "name")))
    pieces = F.date_trunc(chunk, "t")
    chunked = previous_value(df, ["customer_id"], ["t", "name"], pieces, "name", "prev")
    assert rows(chunked) == rows(plain)
    plain = df.withColumn("total", F.sum("value").over(part.orderBy("t")))
    chunked = running_total(df, ["customer_id"], "t", pieces, "value", "total")
    assert rows(chunked) == rows(plain)
    order = part.orderBy("t", "name")
    plain = df.withColumn("previous", F.lag("name").over(order)).withColumn(
        "is_new", F.expr("int(previous IS NULL OR previous != name)")
    )
    plain = plain.withColumn("run", F.sum("is_new").over(part.orderBy("t")))
    assert rows(numbered_runs(df, ["customer_id"], "t", "name", pieces)) == rows(plain)
    some = df.groupBy("customer_id").agg(F.max("t").alias("bound")).filter("customer_id <> 2")
    assert rows(numbered_runs(df, ["customer_id"], "t", "name", pieces, some), *plain.columns, "bound") == rows(
        plain.join(some, "customer_id"), *plain.columns, "bound"
    )


def test_runs_are_numbered(spark):
    a, b = "a - click - x", "b - click - x"
    minutes = [a, a, b, a, DEPOSIT]
    process = process_of(
        spark, [event(1, n, f"2024-01-05 {10 + i}:00:00") for i, n in enumerate(minutes)]
    )
    found = paths.event_groups(process, paths.conversion_occurrences(process))
    ordered = found.orderBy("event_time").select("is_new_group", "event_group").collect()
    assert [tuple(r) for r in ordered] == [(1, 1), (0, 1), (1, 2), (1, 3)]


def stored(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("disorder", [0, 90])
def test_windows_added_to_a_state_equal_one_build(spark, seed, disorder):
    """Three windows, dealt by arrival; with disorder events arrive up to that many minutes late."""
    rng = random.Random(seed)
    history = [(c, *name.split(" - "), when) for c, name, when in random_history(seed, customers=6, size=200)]
    arrival = [when + timedelta(minutes=rng.randint(0, disorder)) for *_, when in history]
    cuts = sorted(arrival)[60], sorted(arrival)[130]
    windows = [[], [], []]
    for row, came in zip(history, arrival):
        windows[sum(came >= cut for cut in cuts)].append(row)
    state = occurrences = None
    met_hidden = False
    whole = []
    for window in windows:
        whole += window
        process = process_of(spark, window)
        added = path_state.add_window(state, occurrences, process)
        if state is not None:
            hidden = stored(spark, path_state.hidden(state, process, occurrences))
            met_hidden |= not hidden.isEmpty()
            again = path_state.path_state(process_of(spark, whole).join(hidden, "customer_id", "left_semi"))
            added = path_state.without(added, hidden).unionByName(again)
        state = stored(spark, added)
        found = paths.conversion_occurrences(process)
        occurrences = stored(spark, found if occurrences is None else occurrences.unionByName(found))
        want = paths.out_path_4_events(process_of(spark, whole))
        assert rows(path_state.paths_of_state(state, occurrences, date(2023, 7, 31))) == rows(want)
    assert disorder or not met_hidden
    assert state.count() < len(whole)


def test_state_forgets_what_lies_before_the_bound(spark):
    events = [
        event(1, "home - click - a", "2023-11-01 10:00:00"),
        event(1, "home - click - b", "2023-12-01 10:00:00"),
        event(1, DEPOSIT, "2023-12-05 10:00:00"),
        event(2, "home - click - a", "2023-11-01 10:00:00"),
        event(2, DEPOSIT, "2023-11-05 10:00:00"),
    ]
    actions = [(1, K.FUND_BUY, at("2023-12-03 10:00:00"), money(5), "F1"), (1, K.FUND_SELL, at("2023-12-06 10:00:00"), money(5), "F1")]
    process = process_of(spark, events)
    state, occurrences = path_state.path_state(process), paths.conversion_occurrences(process)
    extra = process_of(spark, [], actions)
    for since in (date(2023, 7, 31), date(2023, 11, 20), date(2023, 12, 4)):
        bound = at(f"{since} 00:00:00")
        recent = process_of(spark, [e for e in events if e[-1] >= bound], [a for a in actions if a[2] >= bound])
        found = path_state.paths_of_state(state, occurrences, since, extra)
        assert rows(found) == rows(paths.out_path_4_events(recent))


def test_a_later_window_reads_new_events_and_the_state_only(spark, tmp_path):
    for name in ("old", "new"):
        process_of(spark, [event(1, DEPOSIT, "2024-01-05 10:00:00")]).write.parquet(f"{tmp_path}/{name}")
    old, new = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("old", "new"))
    path_state.path_state(old).write.parquet(f"{tmp_path}/state")
    paths.conversion_occurrences(old).write.parquet(f"{tmp_path}/occurrences")
    kept = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("state", "occurrences")]
    files = {f.rsplit("/", 2)[1] for f in path_state.add_window(*kept, new).inputFiles()}
    assert files == {"state", "occurrences", "new"}
