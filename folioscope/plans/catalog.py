"""Every operator as a query over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope import constants as K
from folioscope.functions.times import in_window
from folioscope.operators import (
    actions,
    events,
    features,
    fund_monthly,
    members,
    metrics,
    monthly,
    path_state,
    paths,
    static,
)
from folioscope.plans import summaries, upkeep
from folioscope.plans.landing import Landing
from folioscope.session import shared_dir
from folioscope.sinks import state as job_state
from folioscope.sinks import tables as sinks
from folioscope.sources.sample import SampleSources
from folioscope.sources.tables import StoredSources, source_scan

AS_OF, START, END = date(2024, 1, 31), date(2023, 11, 1), date(2024, 2, 1)
MID_AS_OF, MID = date(2024, 1, 15), date(2024, 1, 16)
SEED = 42
KEYWORD = "folioscope"


class Fixture:
    """Sources and landed tables of one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.source = SampleSources(spark, sf_dir)
        self.landed = Landing(self.source, START, END, AS_OF)

    def _stored(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}/{name}"
        sinks.write_table(rows, path)
        return sinks.read_table(self.spark, path)

    @cached_property
    def _shared(self) -> Landing:
        """What hangs on no window, in tables: who is who, daily balances, cancelled orders."""
        sources = StoredSources(self.source, ["eod_accounts"], self._stored)
        shared = Landing(sources, START, END, AS_OF)
        for name in ("ids", "account_ids", "portfolio_ids", "order_cancels"):
            setattr(shared, name, self._stored(name, getattr(shared, name)))
        return shared

    def landing(self, start: date, end: date, as_of: date) -> Landing:
        """The landed tables of a window, for plans that read many of them or several windows.

        Balances are read once for the month ends and the days of all windows.
        """
        made = Landing(self._shared.sources, start, end, as_of)
        made.share(self._shared)
        return made

    @cached_property
    def formatted(self) -> DataFrame:
        return paths.digital_formatted(self.landed.digital_actions, AS_OF)

    @cached_property
    def process(self) -> DataFrame:
        return paths.digital_process(self.formatted, self.landed.actions, AS_OF)

    @cached_property
    def stored_process(self) -> DataFrame:
        """The process as the daily job leaves it: a table, for plans that read it repeatedly."""
        return self._stored("digital_actions_process", self.process)

    @cached_property
    def occurrences(self) -> DataFrame:
        return paths.conversion_occurrences(self.stored_process)

    @cached_property
    def prior(self) -> DataFrame:
        return paths.prior_events(self.stored_process, self.occurrences)


Query = Callable[[Fixture], DataFrame]


def _write_and_read(f: Fixture) -> DataFrame:
    """Write the log of both halves of the window and read the table back."""
    path = f"{shared_dir(f.spark)}/actions"
    at = F.col("timestamp")
    late = F.coalesce(at >= F.lit(str(MID)).cast("timestamp_ntz"), F.lit(False))
    log = f.landed.actions
    sinks.write_table(log.filter(~late), path, "append", f"from-{START}", restart=True)
    sinks.write_table(log.filter(late), path, "append", f"from-{MID}")
    return sinks.read_table(f.spark, path).drop(sinks.LOAD)


def _id_collisions(f: Fixture) -> DataFrame:
    """With a mapping in which some random ids equal the real id of a member that has none."""
    mapping = f.source["serno_mapping"].selectExpr(
        "actual_serno", "CASE WHEN actual_serno % 50 = 0 THEN actual_serno + 49 ELSE random_serno END AS random_serno"
    )
    return members.id_collisions(members.customer_ids(f.source["members"], mapping))


def _interested_fund_count_pd(f: Fixture) -> DataFrame:
    """With fund views laid over two years, as those of the test tables are of one month."""
    views = f.landed.fund_actions.withColumn(
        "timestamp", F.expr("timestamp - make_ym_interval(0, int(customer_id % 24))")
    )
    return metrics.interested_fund_count_pd(views)


def _upload_log(f: Fixture) -> DataFrame:
    """Daily counts, logged twice: first without the fund views, then complete."""

    def entries(table: DataFrame, at: str, name: str, logged_at: date) -> DataFrame:
        return (
            table.groupBy(F.to_date(at).alias("log_date"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(
                "log_date",
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(str(logged_at)).cast("timestamp_ntz").alias("logged_at"),
            )
        )

    digital = f.landed.digital_actions
    partial = digital.filter(F.col("view_name") != "account")
    return sinks.upload_log(
        entries(partial, "event_time", "digital_actions", MID)
        .unionByName(entries(digital, "event_time", "digital_actions", AS_OF))
        .unionByName(entries(f.landed.fund_actions, "timestamp", "fund_actions", AS_OF))
    )


def _feature_merge(f: Fixture) -> DataFrame:
    """The matrix of the first half of the window, with the second half laid over it."""
    old, new = f.landing(START, MID, MID_AS_OF), f.landing(MID, END, AS_OF)
    return summaries.arketip(new, AS_OF, summaries.arketip(old, MID_AS_OF))


def _from_transactions(label: str) -> Query:
    return lambda f: actions.transaction_actions(
        f.source["transactions"], f.landed.account_ids, f.source["funds"], START, END, [label]
    )


def _from_members(label: str) -> Query:
    return lambda f: actions.member_actions(f.source["members"], f.landed.ids, AS_OF, [label])


def _event_feature(name: str) -> Query:
    return lambda f: features.event_features(f.landed.digital_actions, [name])


def _profile(column: str) -> Query:
    return lambda f: static.profile_column(f.landed.member_details, column)


EXTRACTION: dict[str, Query] = {
    "source_scan": lambda f: source_scan(
        f.source["transactions"],
        ["serno", "account_serno", "tx_type", "tx_time", "amount"],
        in_window(F.col("tx_time"), MID, END),
    ),
    "eligible_members": lambda f: members.eligible_members(f.source["members"]),
    "member_by_id": lambda f: members.member_by_id(f.source["members"], 1002),
    "active_account_members": lambda f: members.active_account_members(f.source["accounts"], 1010),
    "members_without_account_sample": lambda f: members.members_without_account_sample(
        f.source["members"], K.SAMPLE_SIZE, SEED
    ),
    "digital_actions": lambda f: f.landed.digital_actions,
    "fund_actions": lambda f: f.landed.fund_actions,
    "monthly_outstandings": lambda f: f.landed.monthly_outstandings,
    "monthly_outstanding_funds": lambda f: f.landed.monthly_outstanding_funds,
    "daily_outstandings": lambda f: f.landed.daily_outstandings,
    "pseudonymize": lambda f: members.pseudonymize(
        f.source["accounts"].select("member_serno", F.col("serno").alias("account_serno")),
        f.source["serno_mapping"],
    ),
    "pseudonymize_strict": lambda f: members.pseudonymize(
        f.source["accounts"].select("member_serno", F.col("serno").alias("account_serno")),
        f.source["serno_mapping"],
        strict=True,
    ),
    "id_collisions": _id_collisions,
    "member_details": lambda f: f.landed.member_details,
    "bias_results": lambda f: f.landed.bias_results,
    "fund_details": lambda f: f.landed.fund_details,
    "popular_funds": lambda f: f.landed.popular_funds,
    "recorded_ibans": lambda f: members.recorded_ibans(f.source["recorded_ibans"]),
    "display_timestamp": lambda f: members.display_details(f.landed.member_details),
    "incremental_slice": lambda f: job_state.incremental_slice(
        f.source["activity"],
        "server_time",
        job_state.next_window({"latest": str(MID), "initial_run": False}, AS_OF),
    ),
    "write_table": _write_and_read,
    "upload_log": _upload_log,
    "row_counts": lambda f: sinks.row_counts(
        {
            name: getattr(f.landed, name)
            for name in ("digital_actions", "fund_actions", "actions", "member_details")
        }
    ),
}

ACTIONS: dict[str, Query] = {
    "act_download": _from_members(K.DOWNLOAD),
    "act_register": _from_members(K.REGISTER),
    "act_cash_in": _from_transactions(K.CASH_IN),
    "act_cash_out": _from_transactions(K.CASH_OUT),
    "act_fund_buy": _from_transactions(K.FUND_BUY),
    "act_fund_sell": _from_transactions(K.FUND_SELL),
    "act_auto_buy": _from_transactions(K.AUTO_BUY),
    "act_auto_sell": _from_transactions(K.AUTO_SELL),
    "act_order_cancel": lambda f: actions.order_cancels(
        f.source["fund_orders"], f.landed.portfolio_ids
    ),
    "act_new_portfolio": lambda f: actions.new_portfolios(
        f.source["portfolios"], f.landed.account_ids
    ),
    "act_profile_picture": _from_members(K.PROFILE_PICTURE),
    "act_multi_iban": lambda f: actions.multiple_ibans(
        f.source["recorded_ibans"], f.landed.ids, AS_OF
    ),
    "actions_all": lambda f: f.landed.actions,
}

PATHS: dict[str, Query] = {
    "digital_formatted": lambda f: f.formatted,
    "ignored_events": lambda f: paths.ignored_events(f.formatted),
    "digital_process": lambda f: f.process,
    "conversion_occurrences": lambda f: paths.conversion_occurrences(f.process),
    "prior_events": lambda f: f.prior,
    "event_prev": lambda f: paths.event_prev(f.process),
    "event_groups": lambda f: paths.event_groups(f.stored_process, f.occurrences),
    "latest_per_event_type": lambda f: paths.latest_per_event_type(f.prior),
    "last_3_events": lambda f: paths.last_3_events(paths.latest_per_event_type(f.prior)),
    "out_path_4_events": lambda f: paths.out_path_4_events(f.stored_process),
}

STATIC: dict[str, Query] = {
    "age_range": lambda f: static.age_range(f.landed.member_details, AS_OF),
    "survey_risk": lambda f: static.survey_risk(f.landed.bias_results),
    "bit_score": lambda f: static.bit_score(f.landed.bias_results),
    "summary_static": lambda f: summaries.summary_static(f.landed, AS_OF),
    "profile_columns": lambda f: static.profile_columns(f.landed.member_details),
    **{f"profile_{column}": _profile(column) for column in static.PROFILE_COLUMNS},
}

MONTHLY: dict[str, Query] = {
    "ym_volumes": lambda f: monthly.ym_volumes(f.landed.monthly_outstandings),
    "ym_transaction_volume": lambda f: monthly.ym_transaction_volume(f.landed.actions),
    "ym_activity_count": lambda f: monthly.ym_activity_count(f.landed.actions),
    "ym_interested_fund_count": lambda f: monthly.ym_interested_fund_count(f.landed.fund_actions),
    "ym_average_outstanding": lambda f: monthly.ym_average_outstanding(f.landed.daily_outstandings),
    "ym_outstanding_trend": lambda f: monthly.ym_outstanding_trend(f.landed.daily_outstandings),
    "ym_interested_fund_risk": lambda f: monthly.ym_interested_fund_risk(
        f.landed.fund_actions, f.landed.fund_details
    ),
    "ym_owned_fund_count": lambda f: monthly.ym_owned_fund_count(
        f.landed.monthly_outstanding_funds
    ),
    "ym_owned_fund_risk": lambda f: monthly.ym_owned_fund_risk(
        f.landed.monthly_outstanding_funds, f.landed.fund_details
    ),
    "ym_hourly_activity": lambda f: monthly.ym_hourly_activity(f.landed.actions),
    "summary_year_month": lambda f: summaries.summary_year_month(f.landing(START, END, AS_OF)),
    "fund_clicks": lambda f: fund_monthly.fund_clicks(f.landed.fund_actions),
    "fund_transaction_volume": lambda f: fund_monthly.fund_transaction_volume(f.landed.actions),
    "fund_outstanding": lambda f: fund_monthly.fund_outstanding(f.landed.monthly_outstanding_funds),
    "summary_year_month_fund": lambda f: summaries.summary_year_month_fund(f.landed),
}

FEATURES: dict[str, Query] = {
    "feature_population": lambda f: features.feature_population(
        f.landed.digital_actions, f.landed.actions, f.landed.member_details
    ),
    "feature_defaults": lambda f: features.feature_defaults(
        features.unmeasured(
            features.feature_population(
                f.landed.digital_actions, f.landed.actions, f.landed.member_details
            ),
            summaries.feature_updates(f.landed, AS_OF).schema,
        )
    ),
    "feature_merge": _feature_merge,
    **{name: _event_feature(name) for name in K.EVENT_FEATURES},
    "dya_score": lambda f: features.dya_score(f.landed.bias_results),
    "has_account_ready": lambda f: features.has_account_ready(f.landed.member_details),
    "otonombuy": lambda f: features.otonombuy(f.landed.digital_actions, f.landed.actions),
    "age_28_48": lambda f: features.age_28_48(f.landed.member_details, AS_OF),
    "katilim_yatirim": lambda f: features.katilim_yatirim(
        f.landed.monthly_outstanding_funds, f.landed.fund_details
    ),
    "faiz_okey": lambda f: features.faiz_okey(f.landed.member_details),
    "katilim_ilgi": lambda f: features.katilim_ilgi(f.landed.fund_actions, f.landed.fund_details),
    "popular_fund_ratio": lambda f: features.popular_fund_ratio(
        f.landed.actions, f.landed.popular_funds
    ),
    "yeni_portfoy": lambda f: features.yeni_portfoy(f.landed.actions),
    "birden_fazla_banka_hesabi": lambda f: features.birden_fazla_banka_hesabi(f.landed.actions),
    "arketip": lambda f: summaries.arketip(f.landed, AS_OF),
}

METRICS: dict[str, Query] = {
    "activity_score_scaled": lambda f: metrics.activity_score_scaled(f.landed.actions),
    "hour_bucket_pct": lambda f: metrics.hour_bucket_pct(f.landed.actions),
    "hour_bucket_pct_filled": lambda f: metrics.hour_bucket_pct(
        f.landed.actions.filter(F.hour("timestamp").between(5, 22)), fill_missing=True
    ),
    "fund_balance_ratio_rows": lambda f: metrics.fund_balance_ratio_rows(
        f.landed.monthly_outstandings
    ),
    "fund_clicks_pd": lambda f: metrics.fund_clicks_pd(f.landed.fund_actions),
    "fund_outstanding_rows": lambda f: metrics.fund_outstanding_rows(
        f.landed.monthly_outstanding_funds
    ),
    "fund_transaction_volume_pd": lambda f: metrics.fund_transaction_volume_pd(f.landed.actions),
    "interested_fund_count_pd": _interested_fund_count_pd,
    "interested_fund_risk_pd": lambda f: metrics.interested_fund_risk_pd(
        f.landed.fund_actions, f.landed.fund_details
    ),
    "outstanding_trend_diff": lambda f: metrics.outstanding_trend_diff(f.landed.daily_outstandings),
    "owned_fund_count_pd": lambda f: metrics.owned_fund_count_pd(
        f.landed.monthly_outstanding_funds
    ),
    "owned_fund_risk_pd": lambda f: metrics.owned_fund_risk_pd(
        f.landed.monthly_outstanding_funds, f.landed.fund_details
    ),
    "transaction_volume_pd": lambda f: metrics.transaction_volume_pd(f.landed.actions),
    "average_outstanding_pd": lambda f: metrics.average_outstanding_pd(f.landed.daily_outstandings),
    "table_fingerprint": lambda f: metrics.table_fingerprint(f.landed.fund_actions, KEYWORD),
}

def _paths_by_window(f: Fixture) -> DataFrame:
    """Paths from the state of the first half of the window, to which the second is added."""
    old, new = Landing(f.source, START, MID, AS_OF), Landing(f.source, MID, END, AS_OF)
    whole = summaries.first_day(AS_OF)
    folder = shared_dir(f.spark)
    state = occurrences = None
    for name, part in (("old", old), ("new", new)):
        digital = paths.digital_formatted(part.digital_actions, AS_OF)
        sinks.write_table(paths.digital_process(digital, part.window_actions, AS_OF), f"{folder}/{name}")
        process = sinks.read_table(f.spark, f"{folder}/{name}")
        sinks.write_table(path_state.add_window(state, occurrences, process), f"{folder}/state")
        sinks.write_table(
            paths.conversion_occurrences(process), f"{folder}/occurrences", "append", name
        )
        state = sinks.read_table(f.spark, f"{folder}/state")
        occurrences = sinks.read_table(f.spark, f"{folder}/occurrences").drop(sinks.LOAD)
    none = paths.digital_formatted(new.digital_actions.limit(0), AS_OF)
    snapshot = paths.digital_process(none, new.snapshot_actions, AS_OF)
    return path_state.paths_of_state(state, occurrences, whole, snapshot)


def _summary_by_month(f: Fixture) -> DataFrame:
    """The monthly summary after the first half, its last month then built anew from both halves."""
    path = f"{shared_dir(f.spark)}/summary_year_month"
    by_month = {"mode": "partitions", "partition_by": ["year", "month"]}
    sinks.write_table(summaries.summary_year_month(f.landing(START, MID, MID_AS_OF)), path, **by_month)
    month = f"{MID:%Y/%m}"
    whole = f.landing(MID.replace(day=1), END, AS_OF)
    new = summaries.summary_year_month(summaries.OfMonths(whole, [month]))
    sinks.write_table(new, path, covered=[(MID.year, MID.month)], **by_month)
    return sinks.read_table(f.spark, path)


def _merge_by_bucket(f: Fixture, buckets: int = 64) -> DataFrame:
    """``feature_merge`` on a stored matrix: only buckets with a measured feature are read and rewritten."""
    folder = shared_dir(f.spark)
    old, new = f.landing(START, MID, MID_AS_OF), f.landing(MID, END, AS_OF)
    bucket = upkeep.bucket_of("customer_id", buckets)
    by_bucket = {"mode": "partitions", "partition_by": ["bucket"]}
    sinks.write_table(summaries.arketip(old, MID_AS_OF).withColumn("bucket", bucket), f"{folder}/matrix", **by_bucket)
    sinks.write_table(summaries.feature_updates(new, AS_OF), f"{folder}/updates")
    updates = sinks.read_table(f.spark, f"{folder}/updates")
    chosen = sorted(upkeep.loaded_buckets([updates], buckets))
    matrix = sinks.read_table(f.spark, f"{folder}/matrix")
    merged = features.feature_merge(updates, matrix.filter(F.col("bucket").isin(chosen)))
    sinks.write_table(merged.withColumn("bucket", bucket), f"{folder}/matrix", **by_bucket)
    return sinks.read_table(f.spark, f"{folder}/matrix").drop("bucket")


# Results brought up to date from what an earlier run has stored.
UPKEEP: dict[str, Query] = {
    "out_path_4_events_by_window": _paths_by_window,
    "summary_year_month_by_month": _summary_by_month,
    "feature_merge_by_bucket": _merge_by_bucket,
}

QUERIES: dict[str, Query] = {
    **UPKEEP,
    **EXTRACTION,
    **ACTIONS,
    **PATHS,
    **STATIC,
    **MONTHLY,
    **FEATURES,
    **METRICS,
}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines print them alike."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals})


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(QUERIES[name](Fixture(spark, sf_dir)))
