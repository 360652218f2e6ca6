"""What customers did before they converted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope import constants as K
from folioscope.functions import times
from folioscope.functions.joins import salted_join
from folioscope.functions.ordered import numbered_runs

HISTORY = ["customer_id"]
PATH = ["customer_id", "seq"]
PROCESS_COLUMNS = [
    "customer_id",
    "year",
    "month",
    "source",
    "view_name",
    "action",
    "details",
    "event_field",
    "event_data",
    "details_bef_comma",
    "details_aft_comma",
    "event_data_text",
    "event_data_num",
    "converted_timestamp",
]


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def digital_formatted(
    digital_actions: DataFrame, as_of, months: int = K.LOOKBACK_MONTHS
) -> DataFrame:
    """Recent events with their name: view, action and details up to the first comma."""
    recent = digital_actions.filter(
        F.col("event_time") >= F.add_months(times.day(as_of), -months).cast("timestamp_ntz")
    )
    head = F.split_part("details", F.lit(","), F.lit(1))
    return recent.select(
        "customer_id",
        "view_name",
        "action",
        "details",
        F.concat_ws(
            " - ", _text("view_name"), _text("action"), F.coalesce(head, F.lit(""))
        ).alias("event_field"),
        F.col("event_time").alias("converted_timestamp"),
        F.year("event_time").alias("year"),
        F.month("event_time").alias("month"),
        head.alias("details_bef_comma"),
        F.split_part("details", F.lit(","), F.lit(2)).alias("details_aft_comma"),
        F.lit("").alias("event_data"),
    )


def conversion_events(spark: SparkSession) -> DataFrame:
    """The conversion events, as literal rows, whose size the planner knows to be small."""
    rows = ", ".join(
        f"({seq}, 'last', '{view}', '{action}', '{details}', '{view} - {action} - {details}')"
        for seq, view, action, details in K.CONVERSION_EVENTS
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} "
        "AS t(seq, direction, view_name, action, event_details, event_field)"
    )


def _has_ignored_word() -> Column:
    return F.col("event_field").rlike("(?i)" + "|".join(K.IGNORED_WORDS))


def ignored_events(formatted: DataFrame) -> DataFrame:
    """Event names left out of paths: the fixed ones and those seen with an ignored word."""
    rows = ", ".join(f"('{name}')" for name in K.IGNORED_EVENTS)
    fixed = formatted.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(ignored_event_field)")
    seen = (
        formatted.filter(_has_ignored_word())
        .select(F.col("event_field").alias("ignored_event_field"))
        .distinct()
    )
    return fixed.unionByName(seen)


def _clock(actions: DataFrame, legacy_clock: bool) -> Column:
    """When an action happened.  ``legacy_clock`` reads hours as days and minutes as hours."""
    name = "timestamp"
    at = times.as_time(actions, name)
    if not legacy_clock:
        return at
    span = F.make_interval(days=F.hour(at), hours=F.minute(at))
    return F.to_date(at).cast("timestamp_ntz") + span


def digital_process(
    formatted: DataFrame,
    actions: DataFrame,
    as_of,
    months: int = K.LOOKBACK_MONTHS,
    legacy_clock: bool = False,
) -> DataFrame:
    """Events that count for paths, and the recent actions next to them.

    The ignored names are the fixed ones plus all names in the same events that
    have an ignored word, so leaving them out is a filter on each row; no list
    is joined.
    """
    kept = formatted.filter(~F.col("event_field").isin(*K.IGNORED_EVENTS) & ~_has_ignored_word())
    events = kept.withColumns(
        {
            "source": F.lit("digital"),
            "event_data_text": F.lit(""),
            "event_data_num": F.lit(0).cast("bigint"),
        }
    )
    at = times.as_time(actions, "timestamp")
    recent = actions.filter(F.to_date(at) >= F.add_months(times.day(as_of), -months))
    transactions = recent.select(
        "customer_id",
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.lit("transaction").alias("source"),
        F.lit("").alias("view_name"),
        F.lit("").alias("action"),
        F.col("action_type").alias("details"),
        F.col("action_type").alias("event_field"),
        F.lit("").alias("event_data"),
        F.lit("").alias("details_bef_comma"),
        F.lit("").alias("details_aft_comma"),
        F.col("fund_code").alias("event_data_text"),
        F.round("amount").cast("bigint").alias("event_data_num"),
        _clock(actions, legacy_clock).alias("converted_timestamp"),
    )
    return events.select(*PROCESS_COLUMNS).unionByName(transactions.select(*PROCESS_COLUMNS))


def conversion_occurrences(process: DataFrame) -> DataFrame:
    ends = conversion_events(process.sparkSession).select("seq", "direction", "event_field")
    return process.join(ends, "event_field").select(
        "seq",
        "direction",
        "customer_id",
        "converted_timestamp",
        "event_field",
        "event_data_text",
        "event_data_num",
    )


def latest_conversions(occurrences: DataFrame) -> DataFrame:
    return occurrences.groupBy(*PATH).agg(F.max("converted_timestamp").alias("__last"))


def before_conversion(events: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each event once per kind of conversion that some occurrence follows it with.

    An event lies before some occurrence exactly when it lies before the latest
    one, so events meet one bound per kind instead of every occurrence.
    """
    met = salted_join(events, bounds, "customer_id", ["event_time", "event_type"])
    return met.filter("event_time < __last").drop("__last")


def named_events(process: DataFrame) -> DataFrame:
    return process.selectExpr(
        "customer_id", "converted_timestamp AS event_time", "event_field AS event_type"
    )


def prior_events(process: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Events before a conversion: one row per event and kind of conversion after it."""
    found = before_conversion(named_events(process), latest_conversions(occurrences))
    return found.select(*PATH, "event_time", "event_type")


def event_prev(process: DataFrame, chunk: str = "day") -> DataFrame:
    """Each event with the one before it, per customer by time (name breaks ties)."""
    runs = numbered_runs(
        named_events(process), HISTORY, "event_time", "event_type", F.date_trunc(chunk, "event_time")
    )
    return runs.withColumnRenamed("previous", "prev_event").drop("is_new", "run")


def event_groups(process: DataFrame, occurrences: DataFrame, chunk: str = "day") -> DataFrame:
    """Number the runs of equal events before each kind of conversion.

    A run starts where the event differs from the one before it; events at the
    same time share the number reached after all of them.  Events before a
    conversion are the beginning of the customer's history, so a run has the same
    number there as in the whole history: runs are numbered once per customer, and
    the latest conversions come along with the chunks' summaries.
    """
    seqs = [seq for seq, *_ in K.CONVERSION_EVENTS]
    last = {seq: F.max(F.when(F.col("seq") == seq, F.col("converted_timestamp"))) for seq in seqs}
    bounds = occurrences.groupBy(*HISTORY).agg(
        F.array(*[F.struct(F.lit(seq).alias("seq"), at.alias("at")) for seq, at in last.items()]).alias("bounds")
    )
    runs = numbered_runs(
        named_events(process),
        HISTORY,
        "event_time",
        "event_type",
        F.date_trunc(chunk, "event_time"),
        bounds,
    )
    return runs.withColumn(
        "bound", F.explode(F.filter("bounds", lambda b: F.col("event_time") < b["at"]))
    ).select(
        "customer_id",
        "bound.seq",
        "event_time",
        "event_type",
        F.col("is_new").alias("is_new_group"),
        F.col("run").alias("event_group"),
    )


def latest_per_event_type(prior: DataFrame) -> DataFrame:
    return prior.groupBy(*PATH, "event_type").agg(F.max("event_time").alias("event_time"))


def last_3_events(latest: DataFrame) -> DataFrame:
    """The three kinds of event seen last, the most recent first (name breaks ties)."""
    recency = W.partitionBy(*PATH).orderBy(F.col("event_time").desc(), "event_type")
    return latest.withColumn("event_rank", F.row_number().over(recency)).filter(
        F.col("event_rank") <= 3
    )


def path_rows(occurrences: DataFrame, last: DataFrame) -> DataFrame:
    """One row per conversion with the three kinds of event ranked in ``last`` before it."""
    before = last.groupBy(*PATH).agg(
        *[
            F.max(F.when(F.col("event_rank") == rank, F.col("event_type"))).alias(f"event_{rank}")
            for rank in (1, 2, 3)
        ]
    )
    return occurrences.join(before, PATH).select(
        "seq",
        "direction",
        F.col("customer_id").alias("cust_id"),
        F.col("converted_timestamp").alias("last_event_timestamp"),
        "event_1",
        "event_2",
        "event_3",
        F.col("event_field").alias("event_4"),
        F.col("event_data_text").alias("event_4_data_text"),
        F.col("event_data_num").alias("event_4_data_num"),
    )


def out_path_4_events(process: DataFrame) -> DataFrame:
    """One row per conversion that has an earlier event: the three kinds before it, and itself.

    The three are ranked per customer and kind of conversion, so repeated
    conversions of one kind share them.
    """
    occurrences = conversion_occurrences(process)
    last = last_3_events(latest_per_event_type(prior_events(process, occurrences)))
    return path_rows(occurrences, last)
