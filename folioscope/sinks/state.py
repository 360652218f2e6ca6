"""How far the job has come: the window of the next run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.times import day, in_window

STATE_SCHEMA = "latest string, initial_run boolean, end_date string, run_number bigint"
FIRST_DAY = date(2000, 1, 1)


@dataclass(frozen=True)
class Window:
    """Rows from ``start`` up to but not including ``end`` are new."""

    start: date
    end: date
    initial: bool
    run_number: int = 0
    pinned_end: str | None = None


def _parsed(text: str | None) -> date | None:
    try:
        return date.fromisoformat(text) if text else None
    except ValueError:
        return None


def next_window(state: dict | None, today: date) -> Window:
    """The window that follows ``state``.

    Without a readable state it starts in 2000 and replaces all tables.  A
    pinned ``end_date`` that does not lie after the start gives an empty window.
    """
    state = state or {}
    start = _parsed(state.get("latest")) or FIRST_DAY
    end = _parsed(state.get("end_date")) or today
    initial = state.get("initial_run")
    return Window(
        start=start,
        end=max(start, end),
        initial=initial is None or initial,
        run_number=(state.get("run_number") or 0) + 1,
        pinned_end=state.get("end_date"),
    )


def read_state(spark: SparkSession, path: str) -> dict | None:
    """The newest state under ``path``: a JSON file, or a folder of them."""
    try:
        states = spark.read.schema(STATE_SCHEMA).json(path, multiLine=True)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = states.agg(
        F.max_by(F.struct(*states.columns), F.coalesce("run_number", F.lit(0))).alias("state")
    ).first()["state"]
    return newest.asDict() if newest else None


def write_state(spark: SparkSession, path: str, window: Window) -> None:
    """Record that the run of ``window`` is done; the next one starts at its end."""
    row = [(window.end.isoformat(), False, window.pinned_end, window.run_number)]
    spark.createDataFrame(row, STATE_SCHEMA).coalesce(1).write.mode("append").json(path)


def incremental_slice(
    table: DataFrame, time_column: str, window: Window, day_column: str | None = None
) -> DataFrame:
    """Rows new since the last run.

    ``day_column`` names the day of ``time_column`` in a table partitioned by it;
    then only the window's days are read.
    """
    rows = table.filter(in_window(F.col(time_column), window.start, window.end))
    if day_column is None:
        return rows
    return rows.filter((F.col(day_column) >= day(window.start)) & (F.col(day_column) <= day(window.end)))
