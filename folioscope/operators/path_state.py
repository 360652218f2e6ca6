"""Conversion paths kept up window by window, without reading old events again.

The state has one row per customer and kind of event with the latest time seen
(``seq`` 0) and, per kind of conversion, one with the latest time before the
customer's latest conversion (``seq`` as in the conversions).  Conversions
themselves are kept, being few.  Adding a window takes the old state and the
window's events only:

* the latest conversion is the later of the two;
* the latest time before it is the greatest of the old one, the old latest time
  if that lies before the conversion, and the window's events before it.

Times below a bound can be left out when the state is read: if the latest time of
a kind of event lies below it, so do all others.

An old latest time at or after a new conversion hides what lay before that
conversion.  This needs events out of order across windows; the customers it
concerns are told by ``hidden`` and taken from the full history instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.paths import (
    PATH,
    before_conversion,
    conversion_occurrences,
    last_3_events,
    latest_conversions,
    latest_per_event_type,
    named_events,
    path_rows,
)

STATE_SCHEMA = "customer_id bigint, seq int, event_type string, event_time timestamp_ntz"
LATEST = 0  # in place of the number of a conversion


def _latest(events: DataFrame) -> DataFrame:
    """The latest time per customer and kind of event."""
    return (
        events.groupBy("customer_id", "event_type")
        .agg(F.max("event_time").alias("event_time"))
        .select("customer_id", F.lit(LATEST).alias("seq"), "event_type", "event_time")
    )


def _before(events: DataFrame, bounds: DataFrame) -> DataFrame:
    """Events before the customer's latest conversion of each kind."""
    return before_conversion(events, bounds).select("customer_id", "seq", "event_type", "event_time")


def path_state(process: DataFrame) -> DataFrame:
    """The state after the events of one window, nothing before it."""
    return add_window(None, None, process)


def add_window(
    state: DataFrame | None, old_occurrences: DataFrame | None, process: DataFrame
) -> DataFrame:
    """The state after a further window; ``old_occurrences`` are all conversions before it."""
    events = named_events(process)
    occurrences = conversion_occurrences(process).select(*PATH, "converted_timestamp")
    if old_occurrences is not None:
        occurrences = occurrences.unionByName(old_occurrences.select(*PATH, "converted_timestamp"))
    bounds = latest_conversions(occurrences)
    rows = _latest(events).unionByName(_before(events, bounds))
    if state is not None:
        seen = state.filter(F.col("seq") == LATEST).drop("seq")
        rows = rows.unionByName(state).unionByName(_before(seen, bounds))
    return rows.groupBy("customer_id", "seq", "event_type").agg(F.max("event_time").alias("event_time"))


def hidden(state: DataFrame, process: DataFrame, old_occurrences: DataFrame) -> DataFrame:
    """Customers of whom the old state cannot tell what lay before a new conversion."""
    new = latest_conversions(conversion_occurrences(process))
    old = latest_conversions(old_occurrences).withColumnRenamed("__last", "__old")
    later = new.join(old, PATH, "left").filter("__old IS NULL OR __last > __old")
    seen = state.filter(F.col("seq") == LATEST).select("customer_id", "event_time")
    return (
        later.select("customer_id", "__last")
        .join(seen, "customer_id")
        .filter("event_time >= __last")
        .select("customer_id")
        .distinct()
    )


def without(rows: DataFrame, customers: DataFrame) -> DataFrame:
    return rows.join(customers, "customer_id", "left_anti")


def paths_of_state(
    state: DataFrame, occurrences: DataFrame, since, extra: DataFrame | None = None
) -> DataFrame:
    """``out_path_4_events`` of all events from ``since`` on.

    ``extra`` are events that no window has, such as those every run replaces; they
    meet the conversions afresh each time.
    """
    bound = F.lit(str(since)).cast("timestamp_ntz")
    recent = occurrences.filter(F.col("converted_timestamp") >= bound)
    settled = state.filter((F.col("seq") != LATEST) & (F.col("event_time") >= bound))
    if extra is not None:
        more = named_events(extra).filter(F.col("event_time") >= bound)
        settled = settled.unionByName(_before(more, latest_conversions(recent)))
    return path_rows(recent, last_3_events(latest_per_event_type(settled)))
